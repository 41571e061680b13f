"""Fixed values that must equal the original pipeline's for equal results."""

from __future__ import annotations

# --- fixed values: search keywords, in the original order -------------------
KEYWORDS = [
    "Centro Comercial", "Mercado", "Concesionario", "Supermercado",
    "Clinica", "Hotel", "Centro Medico", "Hospital", "Universidad",
    "Restaurante", "Galeria Comercial", "Tienda", "Store",
    "Consultorio", "Shopping", "Farmacia",
]

# --- fixed values: area-name repair map (mis-decoded name -> proper name) ---
# Keys are the mis-decoded spellings seen in boundary files; lookups go
# through ``normalize_key`` so only the normalised key matters.
CLEAN_NAMES = {
    "ALTO PARANÃ": "ALTO PARANÁ", "ASUNCIÃN": "ASUNCIÓN",
    "BOQUERÃN": "BOQUERÓN", "CAAGUAZÃ": "CAAGUAZÚ",
    "CAAZAPÃ": "CAAZAPÁ", "CANINDEYÃ": "CANINDEYÚ",
    "CONCEPCIÃN": "CONCEPCIÓN", "GUAIRÃ": "GUAIRÁ",
    "ITAPÃA": "ITAPÚA", "ÃEEMBUCÃ": "ÑEEMBUCÚ",
    "PARAGUARÃ": "PARAGUARÁ",
}

# --- fixed values: boundary column names and run defaults -------------------
AREA_LABEL_COLUMN = "ADM1_ES"
AREA_CODE_COLUMN = "ADM1_PCODE"
DEFAULT_RADIUS_M = 1000
LATTICE_SPACING_FACTOR = 0.8          # lattice step = 0.8 x search radius
EARTH_RADIUS_M = 6371000.0
NUM_CHUNKS = 3

# --- fixed values: result-page layout "loc1" (CSS classes of the panel) -----
ANCHOR_CLASS = "hfpxzc"
CARD_CLASSES = ["CpccDe", "Nv2PK", "section-result"]   # nearest-ancestor preference
NAME_CLASS = "qBF1Pd"
BLOCK_CLASS = "W4Efsd"
RATING_ROW_CLASS = "AJB7ye"
RATING_CLASS = "ZkP5Je"
AMENITY_ROW_CLASS = "ktbgEf"
PRICE_SYMBOL = "₲"

# --- fixed values: search URL format ----------------------------------------
SEARCH_BASE_URL = "https://www.google.com/maps/search/"
SEARCH_URL_SUFFIX = "/data=!3m1!4b1?hl=es-419&gl=PY"

# --- fixed values: projected CRS (EPSG:5880, American polyconic on GRS80) ---
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
POLYCONIC_LAT0 = 0.0
POLYCONIC_LON0 = -54.0
POLYCONIC_X0 = 5000000.0
POLYCONIC_Y0 = 10000000.0
