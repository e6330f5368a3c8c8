"""Plain descriptions of inputs, outputs, masking rules and table plans."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from types import MappingProxyType

from pyspark.sql.types import StructType

DEFAULT_PARTITION_COLUMN = "dt"


@dataclass(frozen=True)
class InputSpec:
    """Where a DataFrame comes from.

    ``partition_values=None`` loads everything; a list restricts the load to
    those values of ``partition_column`` and must not be empty.
    """

    format: str
    path: str | None = None
    table: str | None = None
    partition_column: str = DEFAULT_PARTITION_COLUMN
    partition_values: tuple[str, ...] | None = None
    delimiter: str = ""
    header: bool = True
    schema: StructType | str | None = None
    repartition: int = -1
    widths: tuple[int, ...] = ()
    root_tag: str = "ROWS"
    row_tag: str = "ROW"
    encoding: str = "UTF-8"


@dataclass(frozen=True)
class OutputSpec:
    """Where a DataFrame goes.

    ``mode`` is ``append`` or ``overwrite_partitions`` (only the partitions that
    occur in the data are replaced, so a repeated run gives the same output).
    ``further_columns`` are partition columns below ``partition_column``.
    ``rebalance`` adds one shuffle that gathers each partition value into few
    files; leave it off when the input is laid out by the same column.
    """

    format: str
    path: str | None = None
    table: str | None = None
    partition_column: str | None = None
    delimiter: str = ""
    header: bool = True
    mode: str = "append"
    rebalance: bool = False
    further_columns: tuple[str, ...] = ()

    @property
    def partitions(self) -> tuple[str, ...]:
        return ((self.partition_column,) if self.partition_column else ()) + self.further_columns


@dataclass(frozen=True)
class Rule:
    """One masking method for one column."""

    column: str
    method: str
    options: Mapping[str, str] = field(default_factory=lambda: MappingProxyType({}))


@dataclass(frozen=True)
class EventClock:
    """The event table that starts the retention clock of each person."""

    source: InputSpec
    value_format: str
    join_column: str
    process_column: str
    process_format: str
    frequency: str
    min_value: str | None = None


@dataclass(frozen=True)
class TablePlan:
    """Everything the configuration says about one data table."""

    base: str
    table: str
    source: InputSpec
    output: OutputSpec
    partition_format: str
    keep_months: int | None
    purge_months: int | None
    purge: bool
    trigger: str
    rules: tuple[Rule, ...]
    clock: EventClock | None = None

    @property
    def name(self) -> str:
        return f"{self.base}.{self.table}"


@dataclass(frozen=True)
class Run:
    """One execution: its date, its mode, and what the random masks need.

    ``row_key`` names the columns that identify a row of the table at hand; the
    masks that do not depend on the value draw from them. ``history`` is the folder in
    which event runs keep keyed hashes of the persons they have masked; without
    it a hidden folder of each output path is used.
    """

    run_date: date
    mode: str = "normal"
    key: str = field(default="", repr=False)
    row_keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    principal: str = ""
    stock_start: date = date(2013, 1, 1)
    history: str | None = None
    # Keys of earlier runs, needed to know again the persons whom they have masked.
    former_keys: tuple[str, ...] = field(default=(), repr=False)
    # Keep, beside the history, which partitions can hold whom, so that event runs open only those.
    person_index: bool = False
    # The folder of the run's state (``lethe.operators.runstate``): a repeated attempt skips the steps that are on record.
    state: str | None = None
    # With a state: partitions masked and recorded at a time; 0 means all at once. Permutations always take all.
    step_partitions: int = 0
    # Names for the masks ``firstname`` and ``lastname``: short lists, or inputs whose first column has
    # them. Without either the lists of the library are used.
    first_names: tuple[str, ...] | InputSpec = field(default=(), repr=False)
    last_names: tuple[str, ...] | InputSpec = field(default=(), repr=False)

    @property
    def identity(self) -> str:
        """What a repeated run has in common with its earlier attempts."""
        return f"{self.run_date.isoformat()}-{self.mode}"

    @property
    def month(self) -> str:
        return self.run_date.strftime("%Y%m")
