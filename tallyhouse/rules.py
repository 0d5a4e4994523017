"""Business rules as data. Every operator takes them as a parameter, with these defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------- fixed values: calendar
MONTH_CODES = ("ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SEP", "OCT", "NOV", "DIC")
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)
MONTH_NAMES_ENGLISH = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# ---------------------------------------------------------------- fixed values: product text
# (prefix, brand), the first one that fits wins
BRAND_PREFIXES = (
    ("NAT", "001 - NATURESSE"),
    ("JDE", "002 - JARDIN DE EVA"),
    ("CED", "003 - CEDRELA"),
    ("AMA", "004 - AMATISTA"),
    ("INM", "006 - INMARCESIBLE"),
    ("MED", "007 - MEDELA"),
    ("AWA", "008 - AWARA"),
    ("PER", "010 - PERSONALIZADO"),
)

# (whole words, replacement), applied once each in this order
PRODUCT_REPLACEMENTS = (
    ("CREM", "CREMA"),
    ("CREMAA", "CREMA"),
    ("HUME", "HUMEC"),
    ("HUMECC", "HUMEC"),
    ("LIQ", "LIQU"),
    ("LIQUU", "LIQU"),
    ("FLORY", "FLOR Y"),
    ("ANTIOX", "ANTI"),
    ("ANTIMOSQ", "ANTI MOSQ"),
    ("ANTMOSQ", "ANTI MOSQ"),
    ("JDE COMB CONC", "JDE COMB CONE"),
    ("RESPIRA", "RESP"),
    ("RELAJATE", "RELA"),
    ("SALES", "SALE"),
    ("EFER ACTI", "EFER ACT"),
    ("EFERV", "EFER"),
    ("PER JAB VEG SPA", "PER JAB VEG"),
    ("NAT ACOND", "NAT ACON"),
    ("NAT GEL DUCH", "NAT GEL DUCHA"),
    ("JABO", "JABON"),
    ("JABONN", "JABON"),
    ("ANTIBAC", "ANTI"),
    ("SHAM KER", "SHAM KERA"),
    ("SHAM KERAA", "SHAM KERA"),
    ("NAT SPLA SLEE NIGH", "NAT SPLASH SLEEPFUL NIGHT"),
)

PACK_REPLACEMENTS = (("2 UND", "2UND"), ("500 ML", "500ML"), ("400 ML", "400ML"))
MISSING_PACK = "NA"
DEFAULT_PACK = "1UND"

# pack size -> units; the first one cannot come out of the pack rule, which stops at a blank
PACK_UNITS = (("15GR X 12UND X 32PQ", 32), ("48UND", 48), ("6UND", 6))
OTHER_PACK_UNITS = 24

# ---------------------------------------------------------------- fixed values: sell-out
CHAIN = "PROMOTORA DE COMERCIO SOCIAL"
WHOLESALER = "MAKRO SUPERMAYORISTA SAS"
PHARMACY = "FARMATODO COLOMBIA SA"

# file key -> client name in the history
RETAILERS = (("PROMOTORA", CHAIN), ("MAKRO", WHOLESALER), ("FARMATODO", PHARMACY))

# (name, store, city)
CHAIN_STORES = (
    ("CARULLA PRADERA DE POTOSI", "CARULLA PRADERA DE POTOSI", "POTOSI"),
    ("CARULLA MANIZALES", "CARULLA MANIZALES", "MANIZALES"),
    ("CARULLA PLAZA CLARO", "CARULLA PLAZA CLARO", "BOGOTA"),
)
WHOLESALE_STORES = (
    ("MAKRO CALLE 30", "MAKRO CALLE 30", "SOLEDAD"),
    ("ESTACION POBLADO", "ESTACION POBLADO", "MEDELLIN"),
    ("CALI - NORTE", "NORTE", "CALI"),
)
UNKNOWN_CITY = "CIUDAD DESCONOCIDA"
ONLY_STORE = "Tienda Única"

# the wholesaler's month matrix: preamble lines, header lines, id columns, measure, file extension
MATRIX_PREAMBLE_LINES = 18
MATRIX_HEADER_LINES = 2
MATRIX_IDS = ("Tienda", "Número de artículo Makro", "Descripción del artículo", "Codigo de barras")
MATRIX_MEASURE = "Cde."
LANDED_SUFFIX = ".xlsx"

# ---------------------------------------------------------------- fixed values: sales
MARKER_KEYS = ("Marca", "Linea de mercado", "Razon social", "Fecha", "Cantidad inv.", "Valor bruto local")
SALES_CUTOFF = "2025-01-01"
COST_YEAR = 2025
MISSING_TEXT = ("nan", "None", "", "NaN")

# ---------------------------------------------------------------- fixed values: segmentation
EXCLUDED_REFERENCES = ("10133", "10137", "10138", "10135", "13035", "13034", "1501", "1502")
CHANNELS = (
    "003 - WEBSITE",
    "007 - HOTELES",
    "011 - REDES SOCIALES",
    "016 - INSTITUCIONAL/EMPRESA",
    "009 - PUNTO DE VENTA",
    "013 - ECOMMERCE",
)
SEGMENTS = {
    "Campeones": (555, 554, 544, 545, 454, 455, 445),
    "Leales": (543, 444, 435, 355, 354, 345, 344, 335),
    "Con potencial": (
        553, 551, 552, 541, 542, 533, 532, 531, 452, 451, 442, 441, 431, 453, 433, 432, 423, 353, 352, 351, 342,
        341, 333, 323,
    ),
    "Nuevos clientes": (512, 511, 422, 421, 412, 411, 311),
    "Movilizar": (525, 524, 523, 522, 521, 515, 514, 513, 425, 424, 413, 414, 415, 315, 314, 313),
    "Prestar atención": (535, 534, 443, 434, 343, 334, 325, 324),
    "Ballenas": (155, 154, 144, 214, 215, 115, 114, 113),
    "Cerca de hibernar": (331, 321, 312, 221, 213),
    "En riesgo": (
        255, 254, 245, 244, 253, 252, 243, 242, 235, 234, 225, 224, 153, 152, 145, 143, 142, 135, 134, 133, 125,
        124,
    ),
    "Hibernando": (332, 322, 231, 241, 251, 233, 232, 223, 222, 132, 123, 122, 212, 211),
    "Inactivos": (111, 112, 121, 131, 141, 151),
}
NO_SEGMENT = "No clasificado"
# ---------------------------------------------------------------- end of the fixed values

SEGMENT_OF_SCORE = {score: name for name, scores in SEGMENTS.items() for score in scores}


@dataclass(frozen=True)
class PackRule:
    """Units per pack, for the sales of one customer and brand."""

    customer: str = WHOLESALER
    brand: str = BRAND_PREFIXES[0][1]
    units: tuple[tuple[str, int], ...] = PACK_UNITS
    otherwise: int = OTHER_PACK_UNITS


@dataclass(frozen=True)
class ProductRules:
    """The ordered text rules of the sales enrichment."""

    brands: tuple[tuple[str, str], ...] = BRAND_PREFIXES
    replacements: tuple[tuple[str, str], ...] = PRODUCT_REPLACEMENTS
    packs: tuple[tuple[str, str], ...] = PACK_REPLACEMENTS
    pack_rule: PackRule = field(default_factory=PackRule)
    ignore_case_in_name: bool = False
