"""Business constants of the retail model.

Fixed values: lists, labels, limits and patterns in this file are part of the
expected results and must stay as they are. Limits are parameters of a preset,
because sensible limits depend on the data.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from tallyhouse.functions.bands import PriceClasses

# State code -> (state name, region), the 27 federal units of Brazil.
STATES = {
    "AC": ("Acre", "Norte"),
    "AP": ("Amapá", "Norte"),
    "AM": ("Amazonas", "Norte"),
    "PA": ("Pará", "Norte"),
    "RO": ("Rondônia", "Norte"),
    "RR": ("Roraima", "Norte"),
    "TO": ("Tocantins", "Norte"),
    "AL": ("Alagoas", "Nordeste"),
    "BA": ("Bahia", "Nordeste"),
    "CE": ("Ceará", "Nordeste"),
    "MA": ("Maranhão", "Nordeste"),
    "PB": ("Paraíba", "Nordeste"),
    "PE": ("Pernambuco", "Nordeste"),
    "PI": ("Piauí", "Nordeste"),
    "RN": ("Rio Grande do Norte", "Nordeste"),
    "SE": ("Sergipe", "Nordeste"),
    "DF": ("Distrito Federal", "Centro-Oeste"),
    "GO": ("Goiás", "Centro-Oeste"),
    "MT": ("Mato Grosso", "Centro-Oeste"),
    "MS": ("Mato Grosso do Sul", "Centro-Oeste"),
    "ES": ("Espírito Santo", "Sudeste"),
    "MG": ("Minas Gerais", "Sudeste"),
    "RJ": ("Rio de Janeiro", "Sudeste"),
    "SP": ("São Paulo", "Sudeste"),
    "PR": ("Paraná", "Sul"),
    "RS": ("Rio Grande do Sul", "Sul"),
    "SC": ("Santa Catarina", "Sul"),
}
STATE_NAMES = {code: name for code, (name, _) in STATES.items()}
STATE_REGIONS = {code: region for code, (_, region) in STATES.items()}

HONORIFIC = r"^(Sr|Sra|Srta|Dr|Dra)\.\s+"

WEEKDAYS = ("Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado")

CHANNEL_LABELS = {"ecommerce": "E-commerce", "loja_fisica": "Loja física"}

COLLECTED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"

VIP, TOP_TIER, REGULAR = SEGMENTS = ("VIP", "TOP_TIER", "REGULAR")

PRICE_CLASSES = PriceClasses(
    dearest="MAIS_CARO_QUE_TODOS",
    cheapest="MAIS_BARATO_QUE_TODOS",
    above_mean="ACIMA_DA_MEDIA",
    below_mean="ABAIXO_DA_MEDIA",
    at_mean="NA_MEDIA",
)
PRICE_CLASS_LABELS = {
    "MAIS_CARO_QUE_TODOS": "Mais caro que todos",
    "ACIMA_DA_MEDIA": "Acima da média",
    "NA_MEDIA": "Na média",
    "ABAIXO_DA_MEDIA": "Abaixo da média",
    "MAIS_BARATO_QUE_TODOS": "Mais barato que todos",
}

UNREGISTERED = {
    "product_name": "Produto não cadastrado",
    "category": "Não cadastrado",
    "brand": "Não cadastrado",
    "price_band": "Não cadastrado",
}

SUSPECT_STATUS = ("Preço suspeito (conferir)", "Confirmado")
YES_NO = ("Sim", "Não")
SUSPECT_COUNT_STATUS = ("A confirmar (preço suspeito)", "Confirmado")
TOTAL_LABEL = "Total"
# End of the fixed values.


@dataclass(frozen=True)
class RetailPreset:
    """Limits as decimal text, from the highest band down."""

    price_bands: tuple[tuple[str, str], ...] = (("1000", "PREMIUM"), ("500", "MEDIO"))
    lowest_price_band: str = "BASICO"
    segments: tuple[tuple[str, str], ...] = (("22000", VIP), ("17000", TOP_TIER))
    lowest_segment: str = REGULAR
    suspect_share: str = "0.6"
    unregistered_percent: int = 1
    ranking_size: int = 10
    sale_order: tuple[str, ...] = ()

    def with_limits(self, **changes) -> RetailPreset:
        return replace(self, **changes)

    @property
    def vip_limit(self) -> str:
        return dict((name, limit) for limit, name in self.segments)[VIP]


# Limits that split the sample tables about as the defaults split a real shop.
SAMPLE = RetailPreset(
    price_bands=(("975", "PREMIUM"), ("925", "MEDIO")),
    segments=(("2100000", VIP), ("1300000", TOP_TIER)),
    sale_order=("source_version",),
)
