"""Portuguese names of the raw tables, cleaned tables and marts.

Fixed values. They let a shop keep its existing raw tables and its existing SQL:
`from_portuguese` accepts raw tables in those names, and `register_views` with
`MART_VIEWS` offers the results under them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyhouse.sources.tables import renamed

# raw table -> our table, then Portuguese column -> our column
RAW = {
    "vendas": ("sales", {
        "id_venda": "sale_id", "data_venda": "sold_at", "id_cliente": "customer_id", "id_produto": "product_id",
        "canal_venda": "channel", "quantidade": "quantity", "preco_unitario": "unit_price",
    }),
    "produtos": ("products", {
        "id_produto": "product_id", "nome_produto": "product_name", "categoria": "category", "marca": "brand",
        "preco_atual": "current_price", "data_criacao": "created_at",
    }),
    "clientes": ("customers", {
        "id_cliente": "customer_id", "nome_cliente": "customer_name", "estado": "state", "pais": "country",
        "data_cadastro": "registered_on",
    }),
    "preco_competidores": ("competitor_prices", {
        "id_produto": "product_id", "nome_concorrente": "competitor", "preco_concorrente": "competitor_price",
        "data_coleta": "collected_at",
    }),
}

_SALE = {
    "sale_id": "id_venda", "sold_at": "data_venda", "sale_date": "data", "sale_hour": "hora",
    "weekday_num": "dia_semana_num", "weekday": "dia_semana", "customer_id": "id_cliente",
    "product_id": "id_produto", "channel": "canal_venda", "quantity": "quantidade",
    "unit_price": "preco_unitario", "revenue": "receita", "is_registered": "produto_cadastrado",
    "sold_before_created": "venda_antes_do_cadastro",
}
_PRODUCT = {
    "product_id": "id_produto", "product_name": "nome_produto", "category": "categoria", "brand": "marca",
    "price_band": "faixa_preco",
}
_CUSTOMER = {
    "customer_id": "id_cliente", "customer_name": "nome_cliente", "state": "estado", "state_name": "nome_estado",
    "region": "regiao", "segment": "segmento_cliente",
}

# our table -> {"": view name, our column: Portuguese column}
SILVER_VIEWS = {
    "products": {"": "produtos", **_PRODUCT, "current_price": "preco_atual", "created_at": "data_criacao"},
    "customers": {
        "": "clientes", **_CUSTOMER, "raw_name": "nome_original", "country": "pais", "registered_on": "data_cadastro",
    },
    "sales": {"": "vendas", **_SALE},
    "competitor_prices": {
        "": "preco_competidores", "product_id": "id_produto", "competitor": "nome_concorrente",
        "competitor_price": "preco_concorrente", "collected_at": "data_coleta", "is_suspect": "preco_suspeito",
    },
}
MART_VIEWS = {
    "customer_segments": {
        "": "clientes_segmentacao", **_CUSTOMER, "total_orders": "total_compras", "revenue": "receita",
        "avg_ticket": "ticket_medio", "first_purchase": "primeira_compra", "last_purchase": "ultima_compra",
        "revenue_rank": "ranking_receita",
    },
    "sales_time": {
        "": "vendas_temporais", **_SALE, "total_sales": "total_vendas", "items_sold": "itens_vendidos",
        "unique_customers": "clientes_unicos",
    },
    "product_sales": {
        "": "vendas_produtos", **_PRODUCT, "is_registered": "produto_cadastrado", "total_sales": "total_vendas",
        "items_sold": "itens_vendidos", "revenue": "receita", "avg_ticket": "ticket_medio",
        "revenue_rank": "ranking_receita", "category_rank": "ranking_na_categoria",
    },
    "sales_detail": {"": "vendas_detalhadas", **_SALE, **_PRODUCT, **_CUSTOMER},
    "price_position": {
        "": "precos_competitividade", **_PRODUCT, "our_price": "nosso_preco",
        "avg_competitor_price": "preco_medio_concorrentes", "min_competitor_price": "preco_minimo_concorrentes",
        "max_competitor_price": "preco_maximo_concorrentes", "competitor_count": "total_concorrentes",
        "pct_vs_avg": "diferenca_pct_vs_media", "pct_vs_min": "diferenca_pct_vs_minimo",
        "price_class": "classificacao_preco", "has_suspect": "possui_preco_suspeito", "revenue": "receita",
        "items_sold": "itens_vendidos",
    },
}


def from_portuguese(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Raw tables in Portuguese names -> raw tables as `RetailModel` takes them."""
    return {RAW[name][0]: renamed(df, RAW[name][1]) for name, df in tables.items()}
