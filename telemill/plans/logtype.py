"""Log types: what a line of some kind must look like and which columns it gives."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemill.functions import clock as clocks
from telemill.functions import numbers
from telemill.functions.text import split_fields

PARTITIONS = tuple(clocks.PARTS)

# Columns that travel with a line but belong to no log type.
RESERVED = ("line", "topic", "partition", "offset", "timestamp", "pos", "status", "reason", "envelope", "writer")


class Record:
    """The fields of one line and its time, as the column rules see them."""

    def __init__(self, tz: str):
        self.fields = F.col("_fields")
        self.epoch = F.col("_epoch")
        self.clock = F.col("_clock")
        self.tz = tz

    def __getitem__(self, index: int) -> Column:
        return F.get(self.fields, F.lit(index))


Rule = Callable[[Record], Column]


@dataclass(frozen=True)
class Output:
    """One table column. A `checked` one must not come out NULL.

    The rule is SQL text in which `{3}` stands for field 3 and `{3:n}` for field
    3 if it is strictly a whole number, or a function of the record that returns
    a Column.
    """

    name: str
    type: str
    rule: Rule | str
    checked: bool = True

    def column(self, record: Record) -> Column:
        if isinstance(self.rule, str):
            sql = re.sub(r"\{(\d+):n\}", r"get(_numbers, \1)", self.rule)
            sql = re.sub(r"\{(\d+)\}", r"get(_fields, \1)", sql)
            return F.expr(f"cast({sql} as {self.type}) as `{self.name}`")
        return self.rule(record).cast(self.type).alias(self.name)


def text(names: str, *fields: int) -> list[Output]:
    """Fields taken over as they are."""
    return [Output(name, "string", f"{{{i}}}", checked=False) for name, i in zip(names.split(), fields, strict=True)]


def whole(width: str, names: str, *fields: int) -> list[Output]:
    """Whole numbers of one width (`smallint`, `int` or `bigint`), as strict as `numbers.integer`."""
    return [Output(name, width, f"try_cast({{{i}:n}} as {width})") for name, i in zip(names.split(), fields, strict=True)]


def real(name: str, index: int) -> Output:
    """A 32-bit number."""
    return Output(name, "float", lambda r: numbers.float32(r[index]))


def derived(name: str, type_: str, rule: Rule | str) -> Output:
    return Output(name, type_, rule)


def clock_parts() -> list[Output]:
    """Partition keys from the line's clock, as numbers."""
    return [Output(p, "smallint", f"{call}(_clock)") for p, call in clocks.PARTS.items()]


def padded_clock_parts() -> list[Output]:
    """Partition keys from the line's clock, as two-digit text."""
    return [
        Output(p, "string", f"{call}(_clock)" if p == "y" else f"lpad({call}(_clock), 2, '0')")
        for p, call in clocks.PARTS.items()
    ]


@dataclass(frozen=True)
class LogType:
    """A kind of log line.

    outputs     table columns in table order, the partition keys y, m, d, h last
    min_fields  a line with fewer fields is `SHORT_ROW`
    epoch       place of the epoch seconds, for types that carry their time so;
                rules find them as `record.epoch`
    clock       the line's time, `record.clock` for the rules; NULL is `BAD_TIME`
    label       the column that names a batch in reports
    tokenize    cuts a line into fields
    broken      fields that cannot be told apart: `UNCLOSED_QUOTE`
    skip        lines that are left out without being an error
    """

    name: str
    outputs: tuple[Output, ...]
    min_fields: int
    clock: Rule
    label: str
    segment_label: str = "segments"
    epoch: int | None = None
    tokenize: Callable[[Column], Column] = split_fields
    broken: Callable[[Column], Column] | None = None
    skip: Callable[[Column], Column] | None = None
    columns: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        columns = tuple(o.name for o in self.outputs)
        object.__setattr__(self, "columns", columns)
        taken = {c for c in columns if c.lower() in RESERVED or c.startswith("_")}
        if taken:
            raise ValueError(f"{self.name}: reserved column names {sorted(taken)}")
        if len({c.lower() for c in columns}) != len(columns):
            raise ValueError(f"{self.name}: column names repeat")
        if columns[-len(PARTITIONS):] != PARTITIONS:
            raise ValueError(f"{self.name}: the last columns must be {', '.join(PARTITIONS)}")
        if self.label not in columns:
            raise ValueError(f"{self.name}: no column {self.label} to label batches with")

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{o.name}` {o.type}" for o in self.outputs)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_REGISTRY: dict[str, LogType] = {}


def register(log_type: LogType, replace: bool = False) -> LogType:
    """Make a log type known by its name."""
    if log_type.name in _REGISTRY and not replace:
        raise ValueError(f"log type {log_type.name} is already registered")
    _REGISTRY[log_type.name] = log_type
    return log_type


def resolve(log_type: str | LogType) -> LogType:
    if isinstance(log_type, LogType):
        return log_type
    try:
        return _REGISTRY[log_type]
    except KeyError:
        raise ValueError(f"unknown log type {log_type!r}; known: {', '.join(registered())}") from None


def registered() -> list[str]:
    return sorted(_REGISTRY)
