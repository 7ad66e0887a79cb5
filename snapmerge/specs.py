"""Dataset specifications: one frozen record per consolidated report.

A spec says which columns an extract keeps, how rows are filtered, which key
merges them, which flow (retention / routing policy of its targets) it runs
and under which table prefix its targets are stored.  Adding a dataset that
follows one of the five flows means registering a spec — the runner dispatches
on ``spec.flow`` (G-09) and names the tables from ``spec.table_prefix``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DatasetSpec:
    dataset_id: str
    name: str
    key: tuple[str, ...]
    cadence: str                                  # daily / weekly / monthly
    keep_columns: tuple[str, ...] | None = None   # None = open schema (keep all)
    status_filter: tuple[str, str] | None = None  # (column, value)
    date_col: str | None = None
    period_col: str | None = None
    footer_key: str | None = None                 # null here = report footer / totals row
    ord_col: str | None = None                    # position of a row inside its extract
    seq_col: str | None = None                    # run sequence when a batch holds several extracts
    money_cols: tuple[str, ...] = ()              # amounts that may land as text, beside those marked by name
    flow: str = "accumulate"                      # see FLOWS
    table_prefix: str = ""                        # stored tables are f"{table_prefix}_{target}"
    display_names: dict[str, str] = field(default_factory=dict)   # column → header in the report


# Flow kinds the runner knows (G-09): month preview + rolling and permanent
# tables; two-level accumulate; accumulate routed by row year; month preview +
# year-routed official; in-place upsert with a totals row.
FLOWS = ("month_preview_rolling", "accumulate", "accumulate_by_row_year", "period_preview_by_year",
         "upsert_with_totals")


# The five datasets, their keys and column lists (snake_case
# names; extracts come with the report's display names).
CONTRACTS = DatasetSpec(
    dataset_id="numero_contratos", name="Contracts", key=("proposal_id",), cadence="daily",
    keep_columns=("proposal_id", "report_date", "dealer_id", "manager", "status", "contract_code",
                  "principal", "financed", "insurance", "branch"),
    status_filter=("status", "PROPOSTA PAGA"), date_col="report_date",
    money_cols=("principal", "financed", "insurance"),
    flow="month_preview_rolling", table_prefix="contracts",
    display_names={"proposal_id": "ID Proposta", "report_date": "Dt Relatório", "dealer_id": "Lojista",
                   "manager": "GP", "status": "Status Proposta", "contract_code": "Cd Contrato",
                   "principal": "Vl Principal", "financed": "Vl Financiamento",
                   "insurance": "(R$) Seguro Prestamista", "branch": "Filial"},
)

STORE_ACTIVITY = DatasetSpec(
    dataset_id="dias_sem_producao", name="Store activity", key=("store_id", "vintage"), cadence="weekly",
    keep_columns=("store_id", "store_name", "vintage", "last_contract_date", "financed_value", "financed_count"),
    period_col="vintage", money_cols=("financed_value",), flow="accumulate", table_prefix="store_activity",
    display_names={"store_id": "Cd Loja", "store_name": "Nm Loja", "vintage": "Safra Mes",
                   "last_contract_date": "Data Ultimo Contrato Date", "financed_value": "Valor Financiamento",
                   "financed_count": "Qtde. Financiamento"},
)

TARGETS = DatasetSpec(
    dataset_id="meta_financiamento_seguro", name="Targets", key=("period", "branch"), cadence="monthly",
    keep_columns=("period", "branch", "production", "target"), period_col="period",
    money_cols=("production", "target"), flow="accumulate_by_row_year", table_prefix="targets",
    display_names={"period": "Anomes Apuracao", "branch": "Filial", "production": "R$ Produção",
                   "target": "R$ Meta"},
)

PORTFOLIO = DatasetSpec(
    dataset_id="carteira_parceiros", name="Portfolio", key=("store_tax_id", "branch", "period"),
    cadence="daily", period_col="period",
    flow="period_preview_by_year", table_prefix="portfolio",
    display_names={"store_tax_id": "Cnpj Da Loja", "branch": "Filial", "period": "Anomes"},
)

COMMISSION = DatasetSpec(
    dataset_id="comissao_a_vista", name="Commission", key=("contract_code", "period"), cadence="monthly",
    period_col="period", footer_key="contract_code", ord_col="ord",
    flow="upsert_with_totals", table_prefix="commission",
    display_names={"contract_code": "Cd Contrato", "period": "Anomes Apuracao",
                   "master_tax_id": "Cnpj Master"},
)

REGISTRY: dict[str, DatasetSpec] = {s.dataset_id: s for s in
                                    (CONTRACTS, STORE_ACTIVITY, TARGETS, PORTFOLIO, COMMISSION)}


def register(spec: DatasetSpec) -> DatasetSpec:
    """Add a dataset; its flow must be one of :data:`FLOWS`."""
    if spec.flow not in FLOWS:
        raise ValueError(f"unknown flow {spec.flow!r}; known: {FLOWS}")
    if not spec.table_prefix:
        raise ValueError("a table_prefix is required")
    REGISTRY[spec.dataset_id] = spec
    return spec


def get_spec(dataset_id: str) -> DatasetSpec:
    """G-10 lookup; an unknown id is an error."""
    try:
        return REGISTRY[dataset_id]
    except KeyError:
        raise KeyError(f"unknown dataset {dataset_id!r}; known: {sorted(REGISTRY)}") from None


def by_cadence(cadence: str) -> list[DatasetSpec]:
    return [s for s in REGISTRY.values() if s.cadence == cadence]
