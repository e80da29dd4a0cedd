"""Results depend on them, so they are stated as they are."""

from __future__ import annotations

# --- Fixed values: state code and state name -------------------------------
STATES = (
    (110, "Rondônia"),
    (120, "Acre"),
    (130, "Amazonas"),
    (140, "Roraima"),
    (150, "Pará"),
    (160, "Amapá"),
    (170, "Tocantins"),
    (210, "Maranhão"),
    (230, "Ceará"),
    (240, "Rio Grande do Norte"),
    (250, "Paraíba"),
    (260, "Pernambuco"),
    (270, "Alagoas"),
    (330, "Rio de Janeiro"),
    (410, "Paraná"),
    (420, "Santa Catarina"),
    (500, "Mato Grosso do Sul"),
    (510, "Mato Grosso"),
    (520, "Goiás"),
    (530, "Distrito Federal"),
)

# --- Fixed values: UF abbreviation and state code --------------------------
UF_CODES = (
    ("RO", 110),
    ("AC", 120),
    ("AM", 130),
    ("RR", 140),
    ("PA", 150),
    ("AP", 160),
    ("TO", 170),
    ("MA", 210),
    ("CE", 230),
    ("RN", 240),
    ("PB", 250),
    ("PE", 260),
    ("AL", 270),
    ("RJ", 330),
    ("PR", 410),
    ("SC", 420),
    ("MS", 500),
    ("MT", 510),
    ("GO", 520),
    ("DF", 530),
)

# --- Fixed values: city as named in the price sheet, and its UF ------------
CITY_UFS = (
    ("brasília", "DF"),
    ("campo_grande", "MS"),
    ("cuiabá", "MT"),
    ("goiânia", "GO"),
    ("belo_horizonte", "MG"),
    ("rio_de_janeiro", "RJ"),
    ("são_paulo", "SP"),
    ("vitória", "ES"),
    ("curitiba", "PR"),
    ("florianópolis", "SC"),
    ("porto_alegre", "RS"),
    ("belém", "PA"),
    ("boa_vista", "RR"),
    ("macapá", "AP"),
    ("manaus", "AM"),
    ("palmas", "TO"),
    ("porto_velho", "RO"),
    ("rio_branco", "AC"),
    ("aracaju", "SE"),
    ("fortaleza", "CE"),
    ("joão_pessoa", "PB"),
    ("maceió", "AL"),
    ("natal", "RN"),
    ("recife", "PE"),
    ("salvador", "BA"),
    ("são_luís", "MA"),
    ("teresina", "PI"),
)

# --- Fixed values: cells a CSV scan takes as missing (pandas' documented set)
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- Fixed values: text forms that count as a number
NUMBER = r"(?i)^\s*[+-]?(inf|infinity|\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?)\s*$"

# --- Fixed values: ASCII white space stripped from the ends of a text ------
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"

# --- Fixed values: headers of the municipality sheet, and our names --------
MUNICIPALITY_HEADERS = (
    ("UF", "uf"),
    ("COD. UF", "cod_uf"),
    ("COD. MUNIC", "cod_municipio"),
    ("NOME DO MUNICÍPIO", "municipio"),
    ("POPULAÇÃO ESTIMADA", "populacao"),
)
