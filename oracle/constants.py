"""Fixed values of the expected results, written out apart from the library under test."""

STATES = ("AC", "AP", "AM", "PA", "RO", "RR", "TO", "AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE", "DF", "GO", "MT", "MS", "ES", "MG", "RJ", "SP", "PR", "RS", "SC")
STATE_NAMES = {
    "AC": "Acre",
    "AP": "Amapá",
    "AM": "Amazonas",
    "PA": "Pará",
    "RO": "Rondônia",
    "RR": "Roraima",
    "TO": "Tocantins",
    "AL": "Alagoas",
    "BA": "Bahia",
    "CE": "Ceará",
    "MA": "Maranhão",
    "PB": "Paraíba",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "RN": "Rio Grande do Norte",
    "SE": "Sergipe",
    "DF": "Distrito Federal",
    "GO": "Goiás",
    "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul",
    "ES": "Espírito Santo",
    "MG": "Minas Gerais",
    "RJ": "Rio de Janeiro",
    "SP": "São Paulo",
    "PR": "Paraná",
    "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina",
}
STATE_REGIONS = {
    "AC": "Norte",
    "AP": "Norte",
    "AM": "Norte",
    "PA": "Norte",
    "RO": "Norte",
    "RR": "Norte",
    "TO": "Norte",
    "AL": "Nordeste",
    "BA": "Nordeste",
    "CE": "Nordeste",
    "MA": "Nordeste",
    "PB": "Nordeste",
    "PE": "Nordeste",
    "PI": "Nordeste",
    "RN": "Nordeste",
    "SE": "Nordeste",
    "DF": "Centro-Oeste",
    "GO": "Centro-Oeste",
    "MT": "Centro-Oeste",
    "MS": "Centro-Oeste",
    "ES": "Sudeste",
    "MG": "Sudeste",
    "RJ": "Sudeste",
    "SP": "Sudeste",
    "PR": "Sul",
    "RS": "Sul",
    "SC": "Sul",
}
WEEKDAYS = ("Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado")
CHANNEL_LABELS = {
    "ecommerce": "E-commerce",
    "loja_fisica": "Loja física",
}
SEGMENTS = ("VIP", "TOP_TIER", "REGULAR")
PRICE_CLASS_LABELS = {
    "MAIS_CARO_QUE_TODOS": "Mais caro que todos",
    "ACIMA_DA_MEDIA": "Acima da média",
    "NA_MEDIA": "Na média",
    "ABAIXO_DA_MEDIA": "Abaixo da média",
    "MAIS_BARATO_QUE_TODOS": "Mais barato que todos",
}
