"""Fixed values of the three report flows.

FIXED VALUES: these patterns, labels, words and bands must equal the ones the
original reports use, so that a register classified here gets the same
population labels and the same indicator numbers. They are kept as plain text,
in the order the reports apply them. Patterns are regular expressions; rules
are ordered ``(pattern, label)`` pairs.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Text cell that means "missing" after a sheet was stringified.
SENTINELS = ("nan",)

# Ethnic groups (multi-label, in this order).
ETHNIC_GROUPS = (
    ("negr|afro|mulat|palen", "Afrodescendiente"),
    ("raiz", "Raizal y/o Isleño"),
    ("indí", "Indígenas"),
    ("git", "Gitano"),
)
# Placement keeps one label for any ethnic group.
ETHNIC_ANY_LABEL = "grupo_etnico"

# Disability, last matching rule wins, case-insensitive.
DISABILITY_REGISTRATION = (
    ("ognitiv|telect", "Cognitiva o Intelectual"),
    ("[ií]sic", "Física"),
    ("visual", "Visual"),
    ("auditiva", "Auditiva"),
    ("múltiple", "Múltiple"),
    ("sordoceguera", "Sordoceguera"),
    ("psicosocial", "Psicosocial"),
    ("capacidad", "Discapacidad"),
)
DISABILITY_GUIDANCE = (
    ("capacidad", "Discapacidad"),
    ("ognitiv|telect", "Cognitiva o Intelectual"),
    ("[ií]sic", "Física"),
    ("visual", "Visual"),
    ("auditiva", "Auditiva"),
    ("múltiple", "Múltiple"),
    ("sordoceguera", "Sordoceguera"),
    ("psicosocial", "Psicosocial"),
)
DISABILITY_PLACEMENT = (
    ("ognitiv|telect", "Cognitiva o Intelectual"),
    ("[ií]sic", "Física"),
    ("visual", "Visual"),
    ("auditiva", "Auditiva"),
    ("múltiple", "Múltiple"),
    ("sordoceguera", "Sordoceguera"),
    ("psicosocial", "Psicosocial"),
)

# Victims of the armed conflict.
VCA_PROGRAMME = "armado"
VCA_CONDITION = "vca|v.c.a"
VCA_CONDITION_PLACEMENT = "vca|v.c.a|ctima"
VCA_LABEL = "VCA"
VCA_LABEL_PLACEMENT = "vca"

# Gender violence.
VVG_CONDITION = ("viole", "vvg")
VVG_CONDITION_PLACEMENT = "vvg|violencia|mch"
VVG_LABEL = "vvg"

# Migrants and returnees.
MIGRANT_CONDITION = "migr|retor"
MIGRANT_DOCUMENT_REGISTRATION = "acional|ermiso|tranje"
MIGRANT_DOCUMENT_GUIDANCE = "dni|ppt|ce"
MIGRANT_LABEL = "Migrante o Retornado"
MIGRANT_CONDITION_PLACEMENT = ("igran", "etorn")
MIGRANT_LABEL_PLACEMENT = "Migrante y/o retronado"

# Reintegrated people.
REINTEGRATED_CONDITION = "rein"
REINTEGRATED_LABEL = "reincorporados"

# Words that mean "none" in two placement columns.
NONE_WORDS_AGREEMENT = ("ninguno", "ninguna")
NONE_WORDS_CONDITION = ("ninguna", "ninguno", "nimguno")

# Education level recode (exact match; other values unchanged).
EDUCATION_RECODE = {
    "técnico": "tecnico",
    "tegnologo": "tecnologo",
    "tecnologa": "tecnologo",
    "universitaria": "universitario",
    "pfofesional": "universitario",
    "profesional": "universitario",
    "primaria": "basica primaria",
    "bachiller": "educación media",
}

# Age bands: (low, high, label, low_inclusive); high is exclusive.
AGE_BANDS = (
    (0, 18, "< 18", False),
    (18, 29, "18-28", True),
    (29, 40, "29-39", True),
    (40, 50, "40-49", True),
    (50, 60, "50-59", True),
    (60, 2000, "> 60", True),
)

# Age groups of the panels: (name, low inclusive or None, high or None, high_inclusive).
AGE_GROUPS = (
    ("elders", 60, None, False),
    ("adults", 29, 60, False),
    ("youth", None, 28, True),
)

# Excel stores a date as the day count from this origin.
EXCEL_ORIGIN = "1899-12-30"
EXCEL_MAX_SERIAL = 2958465  # 9999-12-31
# ------------------------------------------------------------ end FIXED VALUES
