"""Captured place links with their coordinates and place ids."""

LINKS = [
    ("https://www.google.com/maps/place/Despensa+El+Aborigen/data=!4m7!3m6!1s0x945d07e043dda5db:0x2dd10d9911d3d817!8m2!3d-25.3146958!4d-57.670338!16s%2Fg%2F11s6202ndv!19sChIJ26XdQ-AHXZQRF9jTEZkN0S0?authuser=0&hl=es-419&rclk=1",
     -25.3146958, -57.670338, "ChIJ26XdQ-AHXZQRF9jTEZkN0S0"),
    ("https://www.google.com/maps/place/Aso+de+pescadores/data=!4m7!3m6!1s0x945d074ff0c415c1:0xc17be17d5d076b4c!8m2!3d-25.3154697!4d-57.6699066!16s%2Fg%2F11j8k2ts4d!19sChIJwRXE8E8HXZQRTGsHXX3he8E?authuser=0&hl=es-419&rclk=1",
     -25.3154697, -57.6699066, "ChIJwRXE8E8HXZQRTGsHXX3he8E"),
]
