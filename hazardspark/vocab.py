"""Vocabularies and patterns.

Fixed values: the word lists, weights, aliases and patterns below decide
results, so they are stated as data. All are arguments of the operators;
callers may pass their own.
"""

# Portuguese number words (17 is absent on purpose).
NUMBER_WORDS = {
    "uma": 1, "um": 1, "duas": 2, "dois": 2, "tres": 3, "quatro": 4, "cinco": 5, "seis": 6,
    "sete": 7, "oito": 8, "nove": 9, "dez": 10, "onze": 11, "doze": 12, "treze": 13,
    "catorze": 14, "quatorze": 14, "quinze": 15, "dezasseis": 16, "dezesseis": 16,
    "dezoito": 18, "dezanove": 19, "vinte": 20,
}

# Victim patterns for normalised text, one per label.
BODY_VICTIM_PATTERNS = {
    "fatalities": r"(\d+)\s+(pessoas?\s+mortas?|vitimas?\s+mortais?|falecid[oa]s?|morreram)",
    "injured": r"(\d+)\s+(pessoas?\s+feridas?|ferid[oa]s?)",
    "evacuated": r"(\d+)\s+(pessoas?\s+evacuadas?|evacuad[oa]s?)",
    "displaced": r"(\d+)\s+(pessoas?\s+desalojadas?|desalojad[oa]s?|deslocad[oa]s?)",
    "missing": r"(\d+)\s+(pessoas?\s+desaparecidas?|desaparecid[oa]s?)",
}
BODY_VICTIM_LIMIT = 1000
# Letters without which a body pattern cannot match.
BODY_STEMS = {
    "fatalities": ["mort", "falecid", "morreram"],
    "injured": ["ferid"],
    "evacuated": ["evacuad"],
    "displaced": ["desalojad", "deslocad"],
    "missing": ["desaparecid"],
}

# Victim patterns for lower-cased titles.
TITLE_VICTIM_PATTERNS = {
    "fatalities": [
        r"(\d+)\s*mort[oa]s?",
        r"(\d+)\s*vítimas?\s*mortais?",
        r"(\d+)\s*óbitos?",
        r"(?:mata|matou|morr[eu])\s*(\d+)",
        r"(\d+)\s*pessoa[s]?\s*(?:morr[eu]|falec[eu])",
    ],
    "injured": [
        r"(\d+)\s*ferid[oa]s?",
        r"(\d+)\s*pessoa[s]?\s*ferid[ao]s?",
        r"(?:fere|deixa)\s*(\d+)",
        r"(\d+)\s*ferimento[s]?",
    ],
    "evacuated": [
        r"(\d+)\s*evacuad[oa]s?",
        r"(\d+)\s*pessoa[s]?\s*evacuad[ao]s?",
        r"evacuação\s*de\s*(\d+)",
        r"(?:retirou|retirad[oa]s?)\s*(\d+)",
    ],
    "displaced": [
        r"(\d+)\s*desalojad[oa]s?",
        r"(\d+)\s*pessoa[s]?\s*desalojad[ao]s?",
        r"(\d+)\s*(?:sem\s*casa|sem\s*abrigo)",
        r"(?:realojad[oa]s?|realojamento)\s*(\d+)",
    ],
    "missing": [
        r"(\d+)\s*desaparecid[oa]s?",
        r"(\d+)\s*pessoa[s]?\s*desaparecid[ao]s?",
        r"(?:procuram?|procura[s]?)\s*(\d+)",
        r"(\d+)\s*(?:em\s*falta|dado[s]?\s*como\s*desaparecid[oa]s?)",
    ],
}
# Letters without which no title pattern of a label can match.
TITLE_STEMS = {
    "fatalities": ["mort", "bito", "mata", "matou", "morr", "falec"],
    "injured": ["ferid", "fere", "deixa", "ferimento"],
    "evacuated": ["evacu", "retir"],
    "displaced": ["desalojad", "sem", "realoja"],
    "missing": ["desaparecid", "procura", "falta"],
}
# Letters without which no title pattern that ends with its number can match.
TITLE_LEADS = {
    "fatalities": ["mata", "matou", "morr"],
    "injured": ["fere", "deixa"],
    "evacuated": ["evacuação", "retir"],
    "displaced": ["realoja"],
    "missing": ["procura"],
}
# Nouns that may follow a spelled-out number in a title.
TITLE_WORD_NOUNS = {
    "fatalities": r"mort[oa]s?|vítimas?\s*mortais?",
    "injured": r"ferid[oa]s?",
    "evacuated": r"evacuad[oa]s?",
    "displaced": r"desalojad[oa]s?",
    "missing": r"desaparecid[oa]s?",
}
# Spelled-out numbers looked for in titles.
TITLE_NUMBER_WORDS = {
    "um": 1, "uma": 1, "dois": 2, "duas": 2, "três": 3, "tres": 3, "quatro": 4, "cinco": 5,
    "seis": 6, "sete": 7, "oito": 8, "nove": 9, "dez": 10,
}

# Hazard taxonomy; types, terms and subtypes are tried in this order.
HAZARDS = {
    "Flood": {
        "terms": ["cheia", "inundacao", "alagamento", "transbordo", "enchente"],
        "subtypes": {
            "flash_flood": ["cheia rapida", "torrente"],
            "river_flood": ["rio", "margem", "leito"],
            "urban_flood": ["cidade", "urbano", "rua"],
        },
    },
    "Landslide": {
        "terms": ["deslizamento", "desabamento", "desmoronamento", "queda de terra"],
        "subtypes": {
            "rockfall": ["pedra", "rocha"],
            "mudslide": ["lama", "terra"],
            "debris_flow": ["detrito", "material"],
        },
    },
    "Fire": {
        "terms": ["incendio", "fogo", "chama", "queimada"],
        "subtypes": {
            "wildfire": ["florestal", "mata", "campo"],
            "urban_fire": ["edificio", "casa", "predio"],
            "industrial_fire": ["fabrica", "industria"],
        },
    },
    "Storm": {
        "terms": ["tempestade", "temporal", "vento", "vendaval", "ciclone"],
        "subtypes": {
            "windstorm": ["vento", "vendaval"],
            "hailstorm": ["granizo", "saraiva"],
            "thunderstorm": ["trovoada", "relampago"],
        },
    },
}

# Named storms, first match wins.
STORM_NAMES = [
    "leslie", "elsa", "fabien", "ana", "bárbara", "filomena", "celine", "emily", "joaquim",
    "miguel", "martinho", "arlene", "oscar", "karlotta",
]
# Weather search terms.
WEATHER_TERMS = ["cheias", "inundação", "chuva", "tempestade", "neve", "granizo"]
# Terms whose searches are planned first.
PRIORITY_TERMS = ["inundação", "tempestade", "chuva", "enchente", "alagamento"]

# Weighted relevance categories.
RELEVANCE = {
    "victims": (3, ["vitima", "morto", "morreu", "faleceu", "obito"]),
    "injuries": (2, ["ferido", "ferimento", "lesao", "hospital"]),
    "displacement": (2, ["desalojado", "evacuado", "realojado", "abrigo"]),
    "missing": (3, ["desaparecido", "perdido", "procura"]),
    "weather_events": (
        1,
        ["tempestade", "temporal", "inundacao", "cheia", "chuva", "vento", "tornado", "ciclone",
         "granizo", "neve", "gelo", "seca"],
    ),
    "infrastructure": (1, ["estrada", "ponte", "casa", "edificio", "destruicao", "dano"]),
}
MIN_RELEVANCE = 2

# Keyword gate as (keyword, blocking context, weight), and vetoes.
GATE_POSITIVE = [
    ("vitima", ["simulacro", "exercicio"], 3),
    ("morto", ["filme", "livro"], 3),
    ("ferido", ["futebol", "desporto"], 2),
    ("inundacao", [], 1),
    ("temporal", [], 1),
    ("tempestade", [], 1),
    ("evacuado", [], 1),
    ("desalojado", [], 1),
]
GATE_NEGATIVE = [
    "previsao", "previsto", "aviso", "alerta", "meteorologia", "historia", "historico",
    "retrospectiva", "filme", "livro", "desporto", "futebol", "simulacro", "exercicio",
]

# Title pre-filter.
OFF_TOPIC = [
    "futebol", "desporto", "filme", "música", "exposição", "festival", "política", "economia",
    "eleições", "parlamento", "governo", "arte", "cultura", "literatura", "teatro", "cinema",
    "turismo", "saúde", "médico", "hospital", "educação", "escola",
]
ON_TOPIC = [
    "incêndio", "inundação", "temporal", "vento", "chuva", "neve", "morto", "ferido",
    "evacuado", "granizo", "trovoada",
]

# Foreign-news words (title or url) and url-only hints.
FOREIGN_COUNTRIES = [
    "frança", "franca", "espanha", "australia", "austrália", "paquistão", "paquistao", "itália",
    "italia", "nepal", "índia", "india", "china", "estados unidos", "eua", "brasil", "rússia",
    "russia", "japão", "japao", "alemanha", "reino unido", "bélgica", "belgica",
]
FOREIGN_URL_HINTS = ["internacional", "mundo", "global"]

# Words that exclude an article from the national set.
NATIONAL_EXCLUDED = [
    "espanha", "franca", "nepal", "cuba", "eua", "brasil", "japao", "valencia", "internacional",
    "mundo", "europa", "america", "africa", "global", "china", "paquistao",
]

# Geographic filter.
DISTRICT_VARIANTS = ["porto", "lisboa", "coimbra", "braga", "aveiro"]
HOME_URL_HINTS = ["portugal", ".pt", "portugues", "portuguesa", "lusa", "lusitania"]
FOREIGN_URL_WORDS = [
    "brasil", "brazil", "espanha", "spain", "franca", "france", "italia", "italy", "alemanha",
    "germany", "inglaterra", "england", "holanda", "netherlands", "belgica", "belgium", "suica",
    "switzerland", "austria", "grecia", "greece", "internacional", "mundial", "global", "europa",
    "america", "africa", "asia",
]

# Content quality.
SOCIAL_MEDIA = ["facebook.com", "twitter.com", "instagram.com"]
FORUM_WORDS = ["forum", "chat", "comments"]
KNOWN_OUTLETS = [
    "rtp.pt", "publico.pt", "dn.pt", "tvi24.pt", "sic.pt", "cmjornal.pt", "jn.pt", "record.pt",
    "observador.pt", "expresso.pt",
]

# Boilerplate.
COOKIE_PATTERNS = [
    r"we usecookiesand data to.*?if you choose to “accept all,”",
    r"we will also use cookies and data to.*?if you",
]
BOILERPLATE = [
    "Saltar para o conteudo", "Este site utiliza cookies", "Iniciar sessao",
    "Politica de Privacidade", "Publicidade", "Registe-se", "Assine ja", "Versao Normal",
    "Mais populares", "Ultimas Noticias", "Facebook", "Google+", "RSS",
]
DAY_PERIODS = ["madrugada", "manha", "tarde", "noite"]

# District spelling corrections.
DISTRICT_ALIASES = {
    "Azores ": "Azores", "Açores": "Azores", "Azores - Terceira": "Azores", "Lisboa ": "Lisboa",
    "Lisboaa": "Lisboa", "Porto ": "Porto", "Santarem": "Santarém", "Santarém ": "Santarém",
    "Braganca": "Bragança", "Evora": "Évora", "Bejá": "Beja", "Trofa": "Porto",
    "Viana Do Castelo": "Viana do Castelo", "Viana do castelo": "Viana do Castelo",
    "Setubal": "Setúbal", "Coímbra": "Coimbra", "Faro ": "Faro", "Portalegre ": "Portalegre",
}

# Region name -> (district, municipality).
REGION_ALIASES = {
    "Douro": ("Vila Real", "Vila Real"),
    "Baixo Vouga": ("Aveiro", "Aveiro"),
    "Grande Lisboa": ("Lisboa", "Lisboa"),
    "Cova da Beira": ("Castelo Branco", "Covilhã"),
    "Médio Tejo": ("Santarém", "Tomar"),
    "Dão-Lafões": ("Viseu", "Viseu"),
    "Alto Trás-os-Montes": ("Bragança", "Bragança"),
    "Tâmega": ("Porto", "Amarante"),
    "Lezíria do Tejo": ("Santarém", "Santarém"),
    "Oeste": ("Leiria", "Caldas da Rainha"),
    "Baixo Mondego": ("Coimbra", "Coimbra"),
    "Beira Interior Sul": ("Castelo Branco", "Idanha-a-Nova"),
    "Beira Interior Norte": ("Guarda", "Guarda"),
    "Cávado": ("Braga", "Braga"),
    "Setubal": ("Setúbal", "Setúbal"),
    "Madeira Island": ("Madeira", "Funchal"),
    "Faro province": ("Faro", "Faro"),
    "Grande Porto": ("Porto", "Porto"),
    "Península de Setúbal": ("Setúbal", "Setúbal"),
    "North": ("Braga", "Braga"),
    "Lisbon": ("Lisboa", "Lisboa"),
    "Seia district (Guarda province)": ("Guarda", "Seia"),
    "Mesao Frio district (Vila Real province)": ("Vila Real", "Mesão Frio"),
    "Agueda": ("Aveiro", "Águeda"),
    "Anadia": ("Aveiro", "Anadia"),
    "Mealhada": ("Aveiro", "Mealhada"),
    "Oliveira do Bairro": ("Aveiro", "Oliveira do Bairro"),
    "Sacavem cities": ("Lisboa", "Loures"),
    "Setubal city": ("Setúbal", "Setúbal"),
    "Loures": ("Lisboa", "Loures"),
    "Funchal": ("Madeira", "Funchal"),
    "Ilha Da Madeira": ("Madeira", "Funchal"),
    "Mesao Frio": ("Vila Real", "Mesão Frio"),
    "Sacavém": ("Lisboa", "Loures"),
    "Ilha da Madeira": ("Madeira", "Funchal"),
    "Mesão Frio": ("Vila Real", "Mesão Frio"),
    "Sacavem": ("Lisboa", "Loures"),
}
UNKNOWN_DISTRICT = "Desconhecido"
# Fallback point of a catalogue event without a centroid.
DEFAULT_POINT = (39.5, -8.0)

# Monthly risk factors and seasons.
FLOOD_RISK = {
    1: 1.8, 2: 1.6, 3: 1.3, 4: 1.0, 5: 0.8, 6: 0.4, 7: 0.3, 8: 0.3, 9: 0.6, 10: 1.0, 11: 1.2,
    12: 1.5,
}
LANDSLIDE_RISK = {
    1: 1.4, 2: 1.2, 3: 1.1, 4: 0.9, 5: 0.7, 6: 0.3, 7: 0.2, 8: 0.2, 9: 0.5, 10: 0.9, 11: 1.1,
    12: 1.3,
}
RAINY_MONTHS = [10, 11, 12, 1, 2, 3]
DRY_MONTHS = [6, 7, 8, 9]

# Names of the months in Portuguese, English, Spanish and French.
MONTH_NAMES = {
    name: number
    for language in (
        "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
        "january february march april may june july august september october november december",
        "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
        "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    )
    for number, name in enumerate(language.split(), 1)
}
