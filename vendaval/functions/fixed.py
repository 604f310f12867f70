"""Values that results depend on. Each block below is a fixed value of the data model.

Lists that only serve as membership sets (states, statuses, months) stand in alphabetical or numerical order.
"""

# Codes of the 27 states by macro-region.
REGION_STATES = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
REGION_OTHER = "Outros"

# Market tier of a state.
TIER_STATES = {
    "Tier 1": ["MG", "PR", "RJ", "RS", "SP"],
    "Tier 2": ["BA", "CE", "DF", "ES", "GO", "PA", "PE", "SC"],
}
TIER_OTHER = "Tier 3"

# Calendar labels, Sunday first and January first.
WEEKDAY_NAMES = ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"]
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]

# Retail season by month.
SEASON_MONTHS = {"Alta": [1, 2, 11, 12], "Baixa": [5, 6, 7, 8]}
SEASON_OTHER = "Media"

# Order status codes, and the ones counted as a sale.
ORDER_STATUSES = [
    "approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable",
]
SALE_STATUSES = ["delivered", "invoiced", "processing", "shipped"]

# Payment groups by payment type.
PAYMENT_GROUPS = {"cartao": ["credit_card", "debit_card"], "boleto": ["boleto"], "voucher": ["voucher"]}
PAYMENT_OTHER = "outro"
PAYMENT_LABELS = {
    "credit_card": "Cartão de Crédito",
    "debit_card": "Cartão de Débito",
    "boleto": "Boleto",
    "voucher": "Voucher",
}

# Delay ladders in days, upper bounds inclusive.
DELAY_STEPS = [(-3, "muito_adiantado"), (0, "no_prazo"), (5, "atraso_leve")]
DELAY_ABOVE = "atraso_grave"
DELAY_UNKNOWN = "sem_informacao"

# Size classes by weight in grams, days since the last sale, upper bounds inclusive.
SIZE_STEPS = [(500, "pequeno"), (5000, "medio")]
SIZE_ABOVE = "grande"
STALE_STEPS = [(30, "Ativo"), (90, "Moderado"), (180, "Baixo")]
STALE_ABOVE = "Inativo"

# Seller tiers by score, lower bounds inclusive; weights and neutral share of the score.
SELLER_TIERS = [(80, "Excelente"), (60, "Bom"), (40, "Regular")]
SELLER_BELOW = "Critico"
SCORE_WEIGHTS = {"review": 40, "on_time": 30, "kept": 20, "volume": 10}
SCORE_NEUTRAL = "0.5"
SCORE_VOLUME_CAP = 100

# Late-risk bands, upper bounds inclusive.
RISK_STEPS = [(0.3, "baixo"), (0.6, "medio")]
RISK_ABOVE = "alto"

# Usage categories and the name fragments that select them, first match wins.
USAGE_CATEGORIES = [
    ("DLT Pipelines", ["%dlt%", "%pipelines%"]),
    ("Model Serving", ["%serving%", "%model%"]),
    ("SQL Warehouse", ["%sql%", "%warehouse%"]),
    ("Serverless Compute", ["%serverless%compute%", "%interactive%"]),
]
USAGE_OTHER = "Outros"

# Fragments per usage report, on the sku name and on the origin product, and exclusions on the sku.
USAGE_WORKLOADS = {
    "dlt": {"sku": ["%dlt%", "%delta_live%", "%pipelines%"], "origin": ["%dlt%", "%pipelines%"], "not_sku": []},
    "ml": {
        "sku": ["%serving%", "%model%", "%inference%", "%ml%"],
        "origin": ["%serving%", "%model%"],
        "not_sku": [],
    },
    "notebook": {
        "sku": ["%serverless%compute%", "%interactive%", "%notebook%"],
        "origin": [],
        "not_sku": ["%sql%", "%dlt%"],
    },
    "sql": {"sku": ["%sql%", "%warehouse%"], "origin": [], "not_sku": []},
}
USAGE_SERIES = {
    "dlt": {"sku": ["%dlt%", "%pipelines%"], "origin": ["%dlt%"], "not_sku": []},
    "ml": {"sku": ["%serving%", "%model%", "%inference%"], "origin": ["%serving%"], "not_sku": []},
}

# Personal-data classes and the action per category.
PII_CLASSES = {
    "CPF_HASH": "IDENTIFICADOR_DIRETO",
    "EMAIL": "IDENTIFICADOR_DIRETO",
    "TELEFONE": "IDENTIFICADOR_DIRETO",
    "NOME": "IDENTIFICADOR_DIRETO",
    "DOCUMENTO": "IDENTIFICADOR_DIRETO",
    "CHAVE_ESTRANGEIRA": "IDENTIFICADOR_INDIRETO",
    "CEP": "QUASI_IDENTIFICADOR",
    "COORDENADA_GPS": "QUASI_IDENTIFICADOR",
    "LOCALIZACAO": "QUASI_IDENTIFICADOR",
    "CONTEUDO_USUARIO": "TEXTO_LIVRE",
    "CARTAO": "DADO_FINANCEIRO",
}
PII_MASKED = ["CPF_HASH", "EMAIL", "TELEFONE", "NOME", "DOCUMENTO", "COORDENADA_GPS", "CONTEUDO_USUARIO", "CARTAO"]

# Patterns of personal data in column names, matched without case.
PII_NAME_PATTERNS = {
    "CPF_HASH": "(customer_id|customer_unique_id|seller_id)",
    "CEP": "zip_code",
    "COORDENADA_GPS": "(geolocation_lat|geolocation_lng|latitude|longitude)",
    "LOCALIZACAO": "(city|cidade|endereco|address|bairro)",
    "CONTEUDO_USUARIO": "(comment|message|descricao|observacao|texto|review_comment)",
    "EMAIL": "(email|e_mail|mail)",
    "TELEFONE": "(phone|telefone|celular|fone)",
    "NOME": "(nome|name|first_name|last_name|razao_social)",
    "DOCUMENTO": "(cpf|cnpj|rg|documento|document)",
}

# Patterns of personal data in values, in the syntax Java and RE2 share. Redaction applies them in this order: the longest
# digit groups first, so that no part of a card or document number is taken for a phone. A number counts as a whole only.
PII_VALUE_PATTERNS = {
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+",
    "CARTAO": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "DOCUMENTO": r"\b[0-9]{3}[.][0-9]{3}[.][0-9]{3}-[0-9]{2}\b",
    "TELEFONE": r"([(][0-9]{2,3}[)] ?|\b[0-9]{2,3}[ -])[0-9]{3,5}[ -][0-9]{4}\b",
    "CEP": r"\b[0-9]{5}-[0-9]{3}\b",
    "COORDENADA_GPS": "-?[0-9]{1,2}[.][0-9]{4,}, ?-?[0-9]{1,3}[.][0-9]{4,}",
}

# A character every match of the pattern holds.
PII_VALUE_SIGNS = {"EMAIL": "@", "CEP": "-", "DOCUMENTO": "-", "COORDENADA_GPS": ","}

# Columns a junior analyst may not see, per layer and table.
JUNIOR_HIDDEN = {
    "raw.customers": ["customer_id", "customer_unique_id"],
    "raw.sellers": ["seller_id"],
    "raw.geolocation": ["geolocation_lat", "geolocation_lng"],
    "raw.reviews": ["review_comment_title", "review_comment_message"],
    "clean.customers": ["customer_id", "customer_unique_id"],
    "clean.sellers": ["seller_id"],
    "clean.reviews": ["review_title", "review_message"],
}
# Roles without hidden columns.
UNRESTRICTED_ROLES = ["admin"]

# Member group whose rows are limited to one macro-region.
REGIONAL_GROUPS = {"Regiao_Norte": REGION_STATES["Norte"]}

# Row-filter functions and the group each one restricts.
ROW_FILTER_FUNCTIONS = {
    "filtro_regiao_norte": "Regiao_Norte",
    "filtro_regiao_norte_customers": "Regiao_Norte",
    "filtro_regiao_norte_sellers": "Regiao_Norte",
}

# Warehouse hand-off keys, distribution then sort.
EXPORT_KEYS = {
    "orders": ("order_id", "order_purchase_timestamp"),
    "customers": ("customer_id", "customer_state"),
    "items": ("order_id", "product_id"),
    "payments": ("order_id", "payment_type"),
    "reviews": ("order_id", "review_score"),
    "products": ("product_id", "product_category"),
    "sellers": ("seller_id", "seller_state"),
    "orders_enriched": ("order_id", "order_purchase_timestamp"),
    "items_enriched": ("order_id", "product_category"),
}

# Model inputs in order, and fill values for missing ones.
MODEL_NUMERIC = [
    "tempo_aprovacao_seg", "tempo_postagem_seg", "total_pago", "max_parcelas", "pag_cartao", "pag_boleto",
    "total_itens_valor", "total_frete", "peso_medio_kg", "volume_medio_cm3", "qtd_itens",
]
MODEL_STATES = ["customer_state", "seller_state"]
MODEL_FILL_ONE = ["max_parcelas", "qtd_itens"]

# Logistic regression settings (name, regularisation, iterations, elastic net, class weighting).
MODEL_RUNS = [
    ("lr_l2", 0.01, 100, 0.0, False),
    ("lr_l1_balanced", 0.1, 200, 1.0, True),
    ("lr_elastic_balanced", 0.05, 150, 0.5, True),
]

# Words that point at the cause of a bad review, first match wins.
REVIEW_CAUSES = [
    ("atraso", "(atras|demor|prazo|late|delay|nunca cheg|não cheg)"),
    ("produto_diferente", "(diferente|errad|trocad|wrong|different)"),
    ("defeito", "(defeit|quebrad|danific|broken|defect)"),
    ("incompleto", "(falt|incomplet|missing|parcial)"),
]
REVIEW_CAUSE_OTHER = "outro"
