"""The business contract: coverage, transport states and thresholds.

Column names are fixed (see ``schemas.py``); a source is mapped onto them at
landing. Everything that the reference reads from its YAML file is a field
here, so functions stay pure ``DataFrame -> DataFrame`` transformations.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's labels for identical outputs).
# Explicit categories for "nothing to report":
NO_INCIDENT = "Sin incidencia"
NO_NOTE = "Sin observación"
# Quarantine reasons for sales, in rule order:
SALES_REASONS = (
    "fecha_venta nula o inválida",
    "ciudad fuera de cobertura",
    "montos negativos",
    "montos inconsistentes",
    "calificacion fuera de 1-5",
    "id_venta repetido",
    "pedido_id repetido",
)
# Quarantine reasons for events, in rule order:
EVENT_REASONS = (
    "pedido sin venta válida",
    "ciudad_destino fuera de cobertura",
)
# Incident kinds and actions:
KIND_DUPLICATE_ROW = "Fila duplicada"
KIND_RESIDUAL_COLUMN = "Columna residual del Excel"
KIND_KEY_CONFLICT = "evento_id repetido con contenido distinto"
KIND_NULL_SUFFIX = " nulo"
KIND_NULL_IN_TRANSPORT_SUFFIX = " nulo en estado de transporte"
KIND_EVENT_TS_NULL = "fecha_evento nula"
KIND_REJECTED = "Registro rechazado"
KIND_INCOMPLETE_TRACE = "Trazabilidad incompleta"
KIND_DELIVERED_UNDATED = "Evento Entregado sin fecha"
KIND_SHARED_TRACKING = "numero_guia compartido entre pedidos"
ACTION_REMOVED = "Eliminada"
ACTION_KEPT_MOST_COMPLETE = "Se conservó la versión más completa"
ACTION_RECOVERED = "Recuperado del mismo pedido"
ACTION_COMPLETED = "Completado con el valor del pedido"
ACTION_KEPT_NULL = "Se mantiene nulo (no recuperable)"
ACTION_QUARANTINED = "Enviado a cuarentena"
ACTION_MARKED_GOLD = "Marcado en Gold"
ACTION_NO_DELIVERY_DATE = "Sin fecha de entrega en Gold"
MISSING_PREFIX = "Faltan: "
RESIDUAL_PREFIX = "unnamed"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    """Parameters of one parent (sales) / child (events) binding.

    ``coverage`` may be a list of city names (a literal ``isin``) or ``None``
    when a coverage DataFrame is passed to the functions that need it.
    """

    coverage: tuple[str, ...] | None = None
    transport_states: tuple[str, ...] = ("A", "R")
    first_state: str = "N"
    delivered_state: str = "R"
    physical_channel: str = "BUILDING"
    max_reject_pct: float = 5.0
    amount_tolerance: float = 1.0
    rating_min: int = 1
    rating_max: int = 5
    # Accepted text formats for timestamps (None = the ISO cast).
    ts_formats: tuple[str | None, ...] = (None,)
    max_loads: int = 48
    # Share (%) of rows that may break a rule, by rule id; a rule that is not named admits none.
    tolerated_pct: Mapping[str, float] = field(default_factory=dict)
    # Gaps of the sources that Gold is expected to show; their size is counted from Silver (GAPS in operators/rules.py).
    expected_gaps: frozenset[str] = frozenset()


FIXTURE_CONTRACT = Contract()
# The test binding has gaps that no recovery can fill (orders none of whose events has the value, orders without
# lines). This contract says which share of rows may have them, so that the whole binding can be published.
# The rules that reconcile Gold and the marts (R22-R24, R27-R33) admit none; two of them expect a difference, which is
# counted from Silver: sales without events are a row of the event table (R27), orders none of whose events has a
# carrier are in no carrier's row.
TOLERANT_CONTRACT = Contract(max_reject_pct=15.0, expected_gaps=frozenset({"sales_without_events", "orders_without_carrier"}), tolerated_pct={
    "R11": 10.0, "R12": 10.0, "R13": 10.0, "R14": 10.0, "R16": 10.0, "R25": 10.0, "R26": 10.0})
# Publications of increments: orders whose events have not arrived yet have no summary and no cost, however many they are.
INCREMENT_CONTRACT = replace(TOLERANT_CONTRACT, tolerated_pct={**TOLERANT_CONTRACT.tolerated_pct, "R25": 100.0, "R26": 100.0})
