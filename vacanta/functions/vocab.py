"""Vocabularies the rules run on.

Everything in this module is data. Callers may pass their own lists to the
rule builders; these are the defaults that give the same labels as the
postings pipeline this library re-implements.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — must stay equal to the original pipeline's lists for equal
# results. Natural order is kept: the order of domains decides which domain is
# "primary", the order of keywords decides the order of matched roles.
# ---------------------------------------------------------------------------

TAXONOMY: dict[str, list[str]] = {
    "DATA_ENGINEERING_PLATFORMS": [
        "data engineer", "big data engineer", "cloud data engineer", "data platform engineer",
        "data infrastructure engineer", "data warehouse engineer", "data lake engineer",
        "lakehouse engineer", "etl developer", "elt developer", "streaming data engineer",
        "data integration engineer", "dataops engineer", "database engineer", "database administrator",
        "dba", "data architect", "cloud data architect", "pyspark", "spark", "kafka", "airflow", "dbt",
    ],
    "DATA_ANALYTICS_BI": [
        "data analyst", "business intelligence analyst", "bi analyst", "bi developer",
        "bi engineer", "analytics engineer", "business analyst", "product data analyst",
        "product analyst", "marketing data analyst", "financial data analyst", "risk data analyst",
        "operations analyst", "customer analyst", "crm analyst", "web analyst", "digital analyst",
        "data visualization specialist", "decision scientist", "power bi", "tableau", "looker",
    ],
    "DATA_SCIENCE": [
        "data scientist", "applied data scientist", "senior data scientist", "lead data scientist",
        "statistical data scientist", "research data scientist", "product data scientist",
        "quantitative analyst", "quant", "statistician", "experimentation scientist",
        "ab testing scientist", "optimization scientist", "operations research scientist",
    ],
    "MACHINE_LEARNING": [
        "machine learning engineer", "ml engineer", "machine learning scientist",
        "applied machine learning engineer", "ml software engineer", "ml infrastructure engineer",
        "ml platform engineer", "mlops engineer", "model deployment engineer",
        "model optimization engineer", "ml research engineer", "applied scientist",
    ],
    "DEEP_LEARNING_SPECIALIZED": [
        "deep learning engineer", "nlp engineer", "nlp scientist", "computer vision engineer",
        "computer vision scientist", "speech ml engineer", "audio ml engineer",
        "recommendation systems engineer", "search engineer", "ranking engineer",
        "recommender systems scientist", "time series scientist", "forecasting scientist",
        "fraud detection ml engineer", "robotics ml engineer", "autonomous systems engineer",
        "reinforcement learning engineer", "graph machine learning engineer",
    ],
    "GENERATIVE_AI_LLM": [
        "generative ai engineer", "genai engineer", "llm engineer", "ai engineer",
        "applied ai engineer", "generative ai developer", "llm application engineer",
        "llm infrastructure engineer", "llmops engineer", "rag engineer",
        "conversational ai engineer", "ai agent engineer", "agentic ai engineer",
        "ai platform engineer", "ai solutions engineer", "ai solutions architect",
        "ai research engineer", "generative ai research scientist", "prompt engineer",
    ],
    "RAG_SEMANTIC_SEARCH": [
        "ai search engineer", "semantic search engineer", "information retrieval engineer",
        "knowledge engineer", "knowledge graph engineer", "vector search engineer",
        "chatbot engineer", "vector database", "embeddings",
    ],
    "MLOPS_LLMOPS_AI_INFRA": [
        "model serving engineer", "ml devops engineer", "ml reliability engineer",
        "ai reliability engineer", "feature store", "model registry", "mlflow",
    ],
    "CLOUD_DATA_AI": [
        "cloud ai engineer", "cloud ml engineer", "cloud solutions architect data ai",
        "cloud platform engineer", "data ai solutions architect", "databricks",
        "snowflake", "bigquery", "synapse", "data factory",
    ],
    "DATA_GOVERNANCE_QUALITY": [
        "data governance analyst", "data governance specialist", "data quality analyst",
        "data quality engineer", "data steward", "master data management specialist",
        "mdm specialist", "metadata management specialist", "data privacy specialist",
        "data security engineer", "data compliance analyst", "data governance manager",
    ],
    "ARCHITECTURE_LEADERSHIP": [
        "big data architect", "ai architect", "ml architect", "generative ai architect",
        "data ai architect", "solutions architect data ai", "enterprise data architect",
        "lead data engineer", "lead ml engineer", "data engineering manager",
        "data science manager", "ai engineering manager", "head of data",
        "head of data engineering", "head of ai", "chief data officer", "cdo",
        "chief ai officer", "caio",
    ],
    "AI_RESEARCH": [
        "ai research scientist", "machine learning research scientist", "deep learning researcher",
        "nlp research scientist", "computer vision research scientist",
        "generative ai research scientist", "llm research scientist", "research engineer",
    ],
}

UNCLASSIFIED_DOMAIN = "NON_CLASSE"

# FIXED VALUES. Domains the quality gate accepts as primary_domain.
ALLOWED_DOMAINS: list[str] = [
    "DATA_ENGINEERING_PLATFORMS", "DATA_ANALYTICS_BI", "DATA_SCIENCE",
    "MACHINE_LEARNING", "DEEP_LEARNING_SPECIALIZED", "GENERATIVE_AI_LLM",
    "RAG_SEMANTIC_SEARCH", "MLOPS_LLMOPS_AI_INFRA", "CLOUD_DATA_AI",
    "DATA_GOVERNANCE_QUALITY", "ARCHITECTURE_LEADERSHIP", "AI_RESEARCH",
    "NON_CLASSE",
]

# FIXED VALUES. Silver-layer word lists (matched on lower-cased text with word boundaries).
INTERNSHIP_WORDS = ["stage", "internship", "intern", "stagiaire", "pfe", "alternance",
                    "apprentissage", "apprenticeship"]
INTERNSHIP_CONTRACT_WORDS = ["stage", "intern"]
ALTERNANCE_CONTRACT_WORDS = ["alternance", "apprentissage", "apprenticeship"]
CDI_WORDS = ["cdi", "indéterminée"]
CDD_WORDS = ["cdd", "déterminée"]
FREELANCE_WORDS = ["freelance", "indépendant"]

PAID_WORDS = ["rémunéré", "remunere", "gratification", "indemnité", "indemnite", "stipend", "salaire"]
UNPAID_WORDS = ["non rémunéré", "non remunere", "bénévole", "unpaid"]

FULL_REMOTE_WORDS = ["full remote", "100% remote", "100% télétravail", "télétravail total"]
HYBRID_WORDS = ["hybride", "hybrid", "télétravail partiel"]
REMOTE_WORDS = ["remote", "télétravail"]

PFE_WORDS = ["pfe", "projet de fin d'études", "fin d'études", "fin d'etude", "pré-embauche",
             "pre-embauche", "end-of-study", "master thesis", "graduation internship"]
CATEGORY_ALTERNANCE_WORDS = ["alternance", "apprentissage", "contrat pro", "work-study", "apprenticeship"]
INITIATION_WORDS = ["initiation", "découverte", "ouvrier", "observation"]
APPLICATION_WORDS = ["stage d'été", "stage technique", "application", "summer intern", "summer internship"]

# FIXED VALUES. Duration units.
WEEK_UNITS = ["semaines", "semaine", "weeks", "week", "-week"]
MONTH_UNITS = ["mois", "months", "month", "-month"]
RANGE_SEPARATORS = ["à", "-", "to"]
INGEST_MONTH_UNITS = ["mois", "months"]

# FIXED VALUES. Labels.
DURATION_BRACKETS = [
    "Non précisée",
    "< 2 mois (Court / Initiation)",
    "2-3 mois (Application / Été)",
    "4-6 mois (PFE / Long)",
    "> 6 mois",
]

# FIXED VALUES. Ingest-time word lists; they differ per source.
INGEST_PFE_WORDS_API = ["pfe", "projet de fin d'études", "fin d'etude"]
INGEST_PFE_WORDS_PAGES = ["pfe", "projet de fin d'études", "fin d'etude", "fin d'études"]
INGEST_STAGE_WORDS_API = ["stage", "internship", "intern", "stagiaire"]
INGEST_STAGE_WORDS_PAGES = ["stage", "internship", "stagiaire"]
INGEST_ALTERNANCE_WORDS_API = ["alternance", "apprentissage", "contrat pro"]
INGEST_ALTERNANCE_WORDS_PAGES = ["alternance", "apprentissage"]
INGEST_PAID_WORDS_API = ["rémunéré", "remunere", "gratification", "indemnité", "indemnite", "stipend", "salary"]
INGEST_PAID_WORDS_PAGES = ["rémunéré", "remunere", "gratification", "indemnité", "indemnite", "stipend"]
INGEST_HYBRID_WORDS_API = ["hybride", "hybrid", "télétravail partiel", "remote partiel"]

# FIXED VALUES. City names found in free text, in priority order (list order wins, not text order).
TEXT_CITIES = ["Casablanca", "Rabat", "Fès", "Tanger", "Marrakech", "Agadir",
               "Salé", "Kénitra", "Oujda", "Tétouan", "Benguerir", "El Jadida", "Mohammedia"]
COMPANY_VERBS = ["recrute", "recrutement"]
COMPANY_STOPS = ["à", "en", "pour"]

# FIXED VALUES. Defaults and placeholders.
UNSPECIFIED = "Non spécifié"
MOROCCO = "Maroc"
API_DEFAULT_COUNTRY = "France"
DEFAULT_ROLE = "Generaliste"
DEFAULT_YEAR = 2026
DEFAULT_MONTH = 10
MAX_JOB_AGE_DAYS = 60
SUMMARY_CHARS = 500
MIN_TITLE_CHARS = 5

SOURCES = ["adzuna_api", "rekrute_scraper", "emploima_scraper", "dreamjob_scraper"]
