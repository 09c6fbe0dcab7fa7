"""Term catalogs (canonical name -> spelling variants).

Catalogs are plain data so that callers can pass their own; the extraction
functions in :mod:`talentflow.functions.terms` compile one literal regex per
canonical name on the driver, so Catalyst sees only constant patterns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

Catalog = Mapping[str, Sequence[str]]

# --- Fixed values: the technology vocabulary (canonical name: variants). ----
# These must equal the upstream vocabulary exactly for results to agree.
TECHNOLOGY_CATALOG: dict[str, list[str]] = {
    "Spark": ["spark", "pyspark", "apache spark"],
    "Databricks": ["databricks"],
    "Azure": ["azure", "microsoft azure"],
    "AWS": ["aws", "amazon web services"],
    "Snowflake": ["snowflake"],
    "Kafka": ["kafka", "apache kafka"],
    "Python": ["python"],
    "Scala": ["scala"],
    "SQL": ["sql", "t-sql", "pl/sql"],
    "Airflow": ["airflow", "apache airflow"],
    "dbt": ["dbt"],
    "Terraform": ["terraform"],
    "Kubernetes": ["kubernetes", "k8s"],
    "Docker": ["docker"],
    "Power BI": ["power bi", "powerbi"],
    "Synapse": ["synapse", "azure synapse"],
    "Fabric": ["microsoft fabric", "ms fabric"],
    "Azure Data Factory": ["azure data factory", "adf"],
    "SQL Server": ["sql server", "mssql"],
    "Git": ["git", "github", "gitlab"],
    "FastAPI": ["fastapi"],
    "Streamlit": ["streamlit"],
    "React": ["react", "react.js", "reactjs"],
}

# --- Fixed values: the working-practice keyword vocabulary. -----------------
KEYWORD_CATALOG: dict[str, list[str]] = {
    "Agile": ["agile"],
    "Scrum": ["scrum"],
    "ETL/ELT": ["etl", "elt"],
    "Data Warehouse": ["data warehouse", "datawarehouse", "dwh"],
    "Data Modeling": ["data modeling", "data model", "modellazione dati"],
    "Data Governance": ["data governance", "governance"],
    "Stakeholder Management": ["stakeholder management", "stakeholder"],
    "CI/CD": ["ci/cd", "continuous integration", "continuous delivery"],
    "DevOps": ["devops"],
    "Mentoring": ["mentoring", "mentorship"],
    "Incremental Loads": ["incremental load", "incremental processing"],
    "Metadata-driven": ["metadata-driven", "metadata driven"],
}

# --- Fixed values: substrings that mark a posting as remote. ----------------
REMOTE_MARKERS: tuple[str, ...] = ("remote", "smart working", "full remote", "telelavoro")


def validate(catalog: Catalog) -> dict[str, list[str]]:
    """Return a plain-dict copy after checking the catalog is usable."""
    out: dict[str, list[str]] = {}
    for name, variants in catalog.items():
        if not isinstance(name, str) or not name:
            raise ValueError(f"catalog names must be non-empty strings, got {name!r}")
        vs = [v for v in variants]
        if not vs or any(not isinstance(v, str) or not v for v in vs):
            raise ValueError(f"catalog entry {name!r} needs non-empty string variants")
        out[name] = vs
    return out
