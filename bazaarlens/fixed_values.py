"""Fixed values.

Everything here is a constant of the data contract (word lists, thresholds, weights, labels,
sentence templates). Results depend on the exact values, so they are kept as plain text in one
place.
"""

# --- category models -------------------------------------------------------------------------
FEATURE_COLUMNS = [
    "total_items_log",
    "domain_count",
    "category_depth",
    "catalog_coverage_score",
    "items_share",
    "competition_density",
]
MIN_ISOLATION_FOREST_ROWS = 30
MIN_CLUSTERING_ROWS = 5
MIN_FORECAST_SNAPSHOTS = 14
MAX_CLUSTERS = 6
CLUSTER_RESTARTS = 10
RANDOM_STATE = 42
Z_SCORE_LIMIT = 3.0
Z_SCORE_SCALE = 20.0
IQR_FACTOR = 1.5
OPPORTUNITY_WEIGHTS = {
    "catalog_coverage": 0.35,
    "low_competition_density": 0.30,
    "category_depth": 0.15,
    "stability": 0.20,
}
MODEL_VERSION = "category_ml_baseline_v1"
FORECAST_MODEL = "naive_previous_snapshot"

# --- coverage bands and their labels ---------------------------------------------------------
COVERAGE_BANDS = ["high_coverage", "medium_coverage", "low_coverage"]
COVERAGE_LABELS = {
    "high_coverage": "Alta cobertura",
    "medium_coverage": "Media cobertura",
    "low_coverage": "Baixa cobertura",
}

# --- question keywords -----------------------------------------------------------------------
SELLER_TERMS = [
    "seller", "vendedor", "anuncio", "anuncios", "produto", "produtos", "estoque", "vendidos",
]
ITEM_LIST_TERMS = [
    "liste", "lista", "quais anuncios", "quais produtos", "anuncios que", "produtos que",
]
# checked in this order, only for seller questions that ask for a list of items
ITEM_INTENTS = [
    ("seller_paused_items", 0.9, ["pausado", "pausados", "paused"]),
    ("seller_zero_sales_items", 0.9,
     ["sem venda", "sem vendas", "nao venderam", "não venderam", "zero venda"]),
    ("seller_top_stock_items", 0.9, ["estoque", "disponivel", "available"]),
    ("seller_expensive_items", 0.9, ["caro", "caros", "maior preco", "preco maior"]),
    ("seller_active_items", 0.9, ["ativo", "ativos", "active"]),
]
# checked in this order, for any other seller question
SELLER_INTENTS = [
    ("seller_sales", 0.88,
     ["vendi", "venda", "vendas", "vender", "vendeu", "venderam", "sales"]),
    ("seller_stock", 0.88, ["estoque", "disponivel", "available"]),
    ("seller_top_categories", 0.86, ["categoria", "categorias", "maior", "mais"]),
    ("seller_summary", 0.82, []),
]
# checked in this order, for questions without a seller term
MARKET_INTENTS = [
    ("top_opportunities", 0.9, ["oportunidade", "opportunity", "score", "melhores"]),
    ("anomalies", 0.9, ["anomalia", "anormal", "outlier"]),
    ("category_variation", 0.75,
     ["variação", "variacao", "mudança", "mudanca", "preço", "preco"]),
    ("marketplace_overview", 0.85, ["overview", "resumo", "geral", "kpi", "indicadores"]),
    ("advanced_ml_status", 0.85, ["forecast", "previs", "cluster", "clustering"]),
]
UNKNOWN_INTENT = ("unknown", 0.0)

# --- answer sentences (%s marks a value) -----------------------------------------------------
ANSWER_UNKNOWN = (
    "Ainda nao tenho uma consulta segura para responder essa pergunta. "
    "Posso responder sobre oportunidades, anomalias, overview, variacao disponivel "
    "status de clustering/forecasting e metricas do seller autenticado."
)
ANSWER_OPPORTUNITIES = (
    "A melhor oportunidade atual e %s com score %s. "
    "Foram avaliadas %s categorias com base nos dados Gold e nas features de ML."
)
ANSWER_OPPORTUNITIES_EMPTY = "Nao ha scores de oportunidade gerados no momento."
ANSWER_ANOMALIES = "Foram encontradas %s anomalias no resultado de ML atual."
ANSWER_ANOMALIES_EMPTY = "Nao ha anomalias marcadas no dataset atual."
ANSWER_VARIATION = (
    "Ainda nao ha historico temporal suficiente para calcular variacoes ou previsoes "
    "de forma robusta. %s"
)
ANSWER_OVERVIEW = (
    "O marketplace monitorado possui %s categorias, %s dominios e "
    "%s itens nas categorias avaliadas."
)
ANSWER_ML_STATUS = "Clustering pronto: %s. %s Forecasting pronto: %s. %s"
ANSWER_SELLER_SUMMARY = (
    "O seller autenticado possui %s anuncios monitorados, "
    "%s ativos, distribuidos em %s categorias. "
    "Ha %s agrupamentos com estoque e nenhuma venda registrada."
)
ANSWER_SELLER_SUMMARY_EMPTY = (
    "Ainda nao ha metricas do seller autenticado. "
    "Execute a coleta OAuth e depois a fase Silver/Gold."
)
ANSWER_SELLER_TOP_CATEGORY = "A categoria com mais anuncios e %s com %s anuncios no status %s."
ANSWER_SELLER_TOP_CATEGORY_EMPTY = (
    "Ainda nao ha categorias do seller autenticado para analisar. "
    "Execute a coleta OAuth e depois a fase Silver/Gold."
)
ANSWER_SELLER_STOCK = (
    "O estoque total monitorado e %s. "
    "A maior concentracao esta em %s com %s unidades. "
    "Ha %s agrupamentos com estoque sem vendas registradas."
)
ANSWER_SELLER_STOCK_EMPTY = (
    "Ainda nao ha dados de estoque do seller autenticado. "
    "Execute a coleta OAuth e depois a fase Silver/Gold."
)
ANSWER_SELLER_SALES = (
    "O total vendido monitorado e %s. "
    "A categoria com maior volume vendido e %s com %s unidades. "
    "O sell-through medio dos agrupamentos e %s%%."
)
ANSWER_SELLER_SALES_EMPTY = (
    "Ainda nao ha dados de vendas do seller autenticado. "
    "Execute a coleta OAuth e depois a fase Silver/Gold."
)
ANSWER_ITEMS_BY_STATUS = "Encontrei %s anuncios com status %s."
ANSWER_ITEMS_BY_STATUS_EMPTY = "Nao encontrei anuncios com status %s nos dados autenticados atuais."
ANSWER_ZERO_SALES = "Encontrei %s anuncios com estoque e zero venda registrada no top analisado."
ANSWER_ZERO_SALES_EMPTY = (
    "Nao encontrei anuncios com estoque e zero venda registrada nos dados atuais."
)
ANSWER_TOP_ITEMS = "Top %s anuncios por %s."
ANSWER_TOP_ITEMS_EMPTY = "Ainda nao ha anuncios autenticados para listar."
ANSWER_ITEM = "%s: preco %s, estoque %s, vendidos %s, status %s."

# --- readiness reasons -----------------------------------------------------------------------
CLUSTERING_READY = "Dataset has enough rows for baseline clustering."
CLUSTERING_NOT_READY = "Requires at least %s rows; current dataset has %s."
FORECASTING_READY = "Dataset has enough temporal snapshots."
FORECASTING_NOT_READY = "Requires at least %s temporal snapshots; current dataset has %s."
FORECASTING_NO_COLUMN = "Dataset has no snapshot_date_key column."
ISOLATION_LIMITATION = "Isolation Forest requires at least %s rows; current dataset has %s."
