"""Word lists, unit tables, patterns and formats that results depend on, as they must be."""

# Patterns, in Java's dialect where it differs ((?d): only \n ends a line; (?U), (?u): Unicode classes and case).
DISPLAY_MATH = r"(?s)\$\$.*?\$\$|\\\[.*?\\\]"
INLINE_MATH = r"(?<!\$)\$(?!\s)[^$\n]+?(?<!\s)\$(?!\$)|\\\(.*?\\\)"
PROTECTED = "[\ue000-\ue003]"
IMAGE = r"(?s)!\[[^\]]*\]\([^)]*\)"
IMAGE_REF = r"(?s)!\[[^\]]*\]\[[^\]]*\]"
HTML_IMG = r"(?is)<img\b[^>]*>"
LINK = r"(?s)\[([^\]]*)\]\([^)]*\)"
LINK_REF = r"(?s)\[([^\]]*)\]\[[^\]]*\]"
LINK_DEF = r"(?md)^ {0,3}\[[^\]]+\]:\s+\S+.*$"
HTML_TABLE = r"(?is)<table\b[^>]*>.*?</table>"
HTML_COMMENT = r"(?s)<!--.*?-->"
HTML_TAG = r"(?s)</?[a-zA-Z][^>]*>"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
FORMAT = r"[\u00AD\u061C\u180E\u200B-\u200F\u202A-\u202E\u2060-\u2064\uFEFF\uFFFD]"
NBSP = r"[\u00A0\u2007\u202F]"
ABBREVIATION = r"(?U)\b[A-ZА-ЯЁ][A-ZА-ЯЁ0-9]*(?:[-–][A-ZА-ЯЁ0-9]+)*\b"
PAGE_NUMBER = r"(?iumd)^ {0,3}(?:[-–—] ?)?(?:(?:стр\.|страница|с\.|page|p\.) ?)?\d{1,4}(?: ?/ ?\d{1,4})?(?: ?[-–—])?[.]?$"
HEADING, BLOCKQUOTE = r"(?md)^ {0,3}#{1,6}\s+", r"(?md)^ {0,3}>\s?"
LIST_ITEM, RULE = r"(?md)^ {0,3}(?:[-*+]|\d+\.)\s+", r"(?md)^ {0,3}(?:-{3,}|\*{3,}|_{3,})\s*$"
ESCAPE, INLINE_CODE, BOLD, STRIKE = r"(?U)\\([^\w\s])", r"`([^`\n]*)`", r"\*\*([^*\n]+)\*\*", r"~~([^~\n]+)~~"
#: Rows of a table, and the blank lines between and after them; two lines at least.
TABLE = r"(?md)^[^\n|]*+\|[^\n|]*+\|[^\n]*+$(?:\n(?:[^\n|]*+\|[^\n|]*+\|[^\n]*+|[^\S\n]*+)$)++"
CELL_SPLIT = r"(?<!\\)\|"
DATE_DMY = r"\b\d{1,2}[./]\d{1,2}[./]\d{4}\b"
DATE_NAMED = r"(?U)\b(\d{1,2})\s+([A-Za-zА-Яа-яЁё]+)\s+(\d{4})(?:\s*(?:г\.|года))?\b"
SCIENTIFIC = r"(?<![0-9A-Za-zА-Яа-яЁё.])(\d+(?:[.,]\d+)?)\s?[·×x]\s?10\s?(?:\^|\*\*)?\s?(-?\d+)(?![0-9A-Za-zА-Яа-яЁё])"
SCIENTIFIC_E = r"(?<![0-9A-Za-zА-Яа-яЁё.])(\d+(?:[.,]\d+)?)[eE]([+-]?\d{1,3})(?![0-9A-Za-zА-Яа-яЁё])"
DECIMAL_DOT = r"(?<![0-9A-Za-zА-Яа-яЁё.,])(\d+)\.(\d+)(?![0-9A-Za-zА-Яа-яЁё.])"
GREEK = ["alpha", "beta", "gamma", "delta", "epsilon", "sigma", "tau", "omega", "theta", "lambda"]
KEPT_IN_FORMULAS = ["Nb", "Ti", "V", "Mo", "Cr", "Ni", "Cu", "Mn", "Si", "Al", "Ca", "Ta", "Zr", "Hf", "W"]
CHEMICAL = r"(?:\[[A-Z][a-z]?\]|[A-Z][a-z]?){2,}"
LETTERS = r"[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\-]*"
ISO_DATE, PLAIN_NUMBER = r"\d{4}-\d{2}-\d{2}", r"[-+]?\d+(?:,\d+)?"
SENTENCE, SENTENCE_SAFE = r"(?<=[.!?])\s+", r"(?<![A-ZА-ЯЁ]\.)(?<=[.!?])\s+"
WORD = r"[A-Za-zА-Яа-яЁё][A-Za-zА-Яа-яЁё\-]*|\d+(?:[.,]\d+)?"
SPECIAL = r"\[(?:FORMULA|NUMUNIT|ABBREV|TABLE)_\d+\]"
LATEX = r"\\[a-zA-Z]+|[A-Za-z]+|\d+(?:[.,]\d+)?|[{}_^+\-=*/()]"
VECTOR_WORD = r"[A-Za-zА-Яа-яЁё0-9][A-Za-zА-Яа-яЁё0-9,.\-]*"
FORMULA = r"(?s)\$\$.*?\$\$|\\\[.*?\\\]|\\\(.*?\\\)|\$[^$\n]+?\$"
NUMUNIT_PARSE = r"^([-+]?\d+(?:[.,]\d+)?)\s*(.*)"
SEPARATORS = ["\n\n", "\n", ". ", "! ", "? ", "; ", ", ", " "]

MONTHS = {
    "январь": 1, "февраль": 2, "март": 3, "апрель": 4, "май": 5, "июнь": 6, "июль": 7, "август": 8, "сентябрь": 9, "октябрь": 10, "ноябрь": 11, "декабрь": 12,
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}

#: Unit as written: (factor to SI, offset, SI symbol).
UNITS = {
    "Н/мм²": (1e6, 0, "kg/m/s**2"), "кг/м³": (1, 0, "kg/m**3"), "г/см³": (1e3, 0, "kg/m**3"), "т/м³": (1e3, 0, "kg/m**3"),
    "Н/мм2": (1e6, 0, "kg/m/s**2"), "кг/м3": (1, 0, "kg/m**3"), "г/см3": (1e3, 0, "kg/m**3"),
    "мм2": (1e-6, 0, "m**2"), "см2": (1e-4, 0, "m**2"), "м2": (1, 0, "m**2"), "мм3": (1e-9, 0, "m**3"), "см3": (1e-6, 0, "m**3"), "м3": (1, 0, "m**3"),
    "км/ч": (1 / 3.6, 0, "m/s"), "м/с": (1, 0, "m/s"), "К/с": (1, 0, "K/s"), "с/мм": (1e3, 0, "s/m"), "об/мин": (0.10471975511965977, 0, "rad/s"), "Н·м": (1, 0, "kg*m**2/s**2"),
    "мм²": (1e-6, 0, "m**2"), "см²": (1e-4, 0, "m**2"), "м²": (1, 0, "m**2"), "мм³": (1e-9, 0, "m**3"), "см³": (1e-6, 0, "m**3"), "м³": (1, 0, "m**3"),
    "мкм": (1e-6, 0, "m"), "мм": (1e-3, 0, "m"), "см": (1e-2, 0, "m"), "дм": (1e-1, 0, "m"), "км": (1e3, 0, "m"),
    "мг": (1e-6, 0, "kg"), "кг": (1, 0, "kg"), "мс": (1e-3, 0, "s"), "мин": (60, 0, "s"), "сут": (86400, 0, "s"),
    "кПа": (1e3, 0, "kg/m/s**2"), "МПа": (1e6, 0, "kg/m/s**2"), "ГПа": (1e9, 0, "kg/m/s**2"), "кН": (1e3, 0, "kg*m/s**2"), "МН": (1e6, 0, "kg*m/s**2"),
    "кВ": (1e3, 0, "kg*m**2/A/s**3"), "мА": (1e-3, 0, "A"), "кГц": (1e3, 0, "1/s"), "МГц": (1e6, 0, "1/s"), "кВт": (1e3, 0, "kg*m**2/s**3"), "МВт": (1e6, 0, "kg*m**2/s**3"),
    "кДж": (1e3, 0, "kg*m**2/s**2"), "мл": (1e-6, 0, "m**3"), "°C": (1, 273.15, "K"), "Па": (1, 0, "kg/m/s**2"), "Н": (1, 0, "kg*m/s**2"), "м": (1, 0, "m"), "с": (1, 0, "s"), "ч": (3600, 0, "s"), "т": (1e3, 0, "kg"),
    "В": (1, 0, "kg*m**2/A/s**3"), "А": (1, 0, "A"), "Ом": (1, 0, "kg*m**2/A**2/s**3"), "Вт": (1, 0, "kg*m**2/s**3"), "Дж": (1, 0, "kg*m**2/s**2"), "Гц": (1, 0, "1/s"), "л": (1e-3, 0, "m**3"), "К": (1, 0, "K"), "рад": (1, 0, "rad"),
    "K": (1, 0, "K"), "m": (1, 0, "m"), "s": (1, 0, "s"), "kg": (1, 0, "kg"), "Pa": (1, 0, "kg/m/s**2"), "MPa": (1e6, 0, "kg/m/s**2"), "m/s": (1, 0, "m/s"), "K/s": (1, 0, "K/s"), "m**2": (1, 0, "m**2"), "m**3": (1, 0, "m**3"),
    "kg/m**3": (1, 0, "kg/m**3"), "kg*m**2/s**2": (1, 0, "kg*m**2/s**2"), "kg/(m*s**2)": (1, 0, "kg/m/s**2"), "kg/m/s**2": (1, 0, "kg/m/s**2"),
}
NOT_ALONE = ["м", "с", "ч", "т", "В", "А", "К", "Н", "л", "%"]

ELEMENTS = ["C", "Mn", "Si", "S", "P", "N", "H", "O", "Al", "Ca", "Ti", "V", "Nb", "Mo", "Cr", "Ni", "Cu", "W", "Ta", "Zr", "Hf", "B"]
ELEMENT_NAMES = {
    "углерод": "C", "марганец": "Mn", "кремний": "Si", "сера": "S", "фосфор": "P", "азот": "N", "водород": "H", "кислород": "O", "алюминий": "Al", "кальций": "Ca", "титан": "Ti",
    "ванадий": "V", "ниобий": "Nb", "молибден": "Mo", "хром": "Cr", "никель": "Ni", "медь": "Cu", "вольфрам": "W", "тантал": "Ta", "цирконий": "Zr", "гафний": "Hf", "бор": "B",
    "carbon": "C", "manganese": "Mn", "silicon": "Si", "sulfur": "S", "sulphur": "S", "phosphorus": "P", "nitrogen": "N", "hydrogen": "H", "oxygen": "O", "aluminum": "Al", "aluminium": "Al",
    "calcium": "Ca", "titanium": "Ti", "vanadium": "V", "niobium": "Nb", "molybdenum": "Mo", "chromium": "Cr", "nickel": "Ni", "copper": "Cu", "tungsten": "W", "tantalum": "Ta",
    "zirconium": "Zr", "hafnium": "Hf", "boron": "B",
}
GENERIC_LABELS = [
    "процесс", "структура", "свойство", "параметр", "фактор", "условие", "частицы", "выделение", "превращение", "зона", "участок", "элемент", "материал", "характеристика", "показатель",
    "режим", "вариант", "образец", "это", "такие", "данные", "результаты", "влияние", "состояние", "область", "класс", "тип", "вид", "форма", "величина", "значение",
]
BAD_IN_LABEL = ["[", "рис.", "табл.", "рисунок", "таблица", "http", "https", "doi"]
UNITS_IN_LABEL = ["%", "°c", "°c", "мм", "см", "мкм", "нм", "мпа", "mpa", "к/с", "k/s", "°c/с", "°c/c", "с/с", "ч", "мин"]
ENTITY_TYPES = ["МАТЕРИАЛ", "ХИМИЧЕСКИЙ_ЭЛЕМЕНТ", "СОЕДИНЕНИЕ", "МИКРОСТРУКТУРА", "ТЕХНОЛОГИЧЕСКИЙ_ПРОЦЕСС", "СВОЙСТВО", "ПАРАМЕТР", "ИЗДЕЛИЕ"]
RELATION_TYPES = ["СОДЕРЖИТ", "ФОРМИРУЕТ", "ПРЕВРАЩАЕТСЯ_В", "ТОРМОЗИТ", "УСКОРЯЕТ", "УЛУЧШАЕТ", "УХУДШАЕТ", "ВЛИЯЕТ_НА", "ПРИМЕНЯЕТСЯ_В", "ТРЕБУЕТ", "ИЗМЕРЯЕТСЯ"]
DEFAULT_ENTITY_TYPE, DEFAULT_RELATION_TYPE = "КОНЦЕПЦИЯ", "ВЛИЯЕТ_НА"
ABBREVIATIONS = {
    "ррт": "ppm", "Interstitial-Free стали": "IF-стали", "Interstitial-Free": "IF", "IF стали": "IF-стали", "Transformation Induced Plasticity стали": "TRIP-стали",
    "Transformation Induced Plasticity": "TRIP", "TRIP стали": "TRIP-стали", "Drop Weight Tear Test": "DWTT", "Lueders elongation": "L.El", "L. El": "L.El",
    "Product Specification Level": "PSL", "Welding Crack Sensitivity": "PCM", "Crack Parameter": "PCM",
}
TERMS = [
    "ТМКП", "ТМО", "ОШЗ", "МА", "ИПГ", "DWTT", "L.El", "IF", "IF-стали", "TRIP", "TRIP-стали", "ОАО", "РАО", "МК", "ВНИИГАЗ", "ВНИИСТ", "ХТЗ", "ЦНИИчермет", "ИТЦ", "ГОСТ", "API", "ASTM", "PSL", "ТТ",
    "К60", "К65", "X70", "X80", "CE", "PCM", "KCV", "KCU", "HV", "Sv", "T5", "T95", "Ar3", "Ac1", "Ac3", "ppm", "Me/C", "C", "Mn", "Si", "S", "P", "N", "H", "O", "Al", "Ca", "Ti",
    "V", "Nb", "Mo", "Cr", "Ni", "Cu", "W", "Ta", "Zr", "Hf", "B",
]
#: C21. Two misread words.
OCR_FIXES = {"С-Мп-Мо-№-В-стали": "C-Mn-Mo-Nb-V-стали", "ниobia": "ниобия"}
