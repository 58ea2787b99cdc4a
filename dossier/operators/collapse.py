"""Entity collapse: a statement history becomes one wide feature row.

One ``groupBy(id).agg(...)`` does all of it. Every aggregate has a fixed-width
buffer, so Spark plans hash aggregation with map-side partials: an entity that
holds a third of all rows reaches the shuffle as one row per map task. Row
order never matters, because "last" is the value at the greatest order key.

Partial rows of a wide table are several times as wide as its rows, and a task
would hold one for every entity in its share of a file. So the rows of a wide
table are first brought together by id, as ``_gathered`` says.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from dossier.functions.levels import level_code, present
from dossier.functions.naming import feature_names
from dossier.operators.vocabulary import Vocabulary
from dossier.session import scratch_path
from dossier.spec import EntitySpec

# Layout of the packed order key: days above, sequence number below.
SEQ_BITS = 40
SEQ_SPAN = 1 << SEQ_BITS
LAST_DAY = "9999-12-31"

# Aggregates per batch: 14 number columns. The methods Spark generates for wider
# aggregates pass the 8000 bytes up to which the JVM compiles a method.
BATCH_AGGREGATES = 42

# Aggregates up to which rows go into partials where they are read: some 300 bytes an entity.
NARROW_AGGREGATES = 20

# How a bigint is cut to be shuffled: lowest bit, bits, and the type that holds them.
PLANES = ((0, 8, "tinyint"), (8, 8, "tinyint"), (16, 16, "smallint"), (32, 32, "int"))


def order_key(df: DataFrame, spec: EntitySpec) -> Column:
    """One number that orders the rows of an entity by date, then sequence.

    Day-precision dates pack into a long. Timestamps need a wide decimal, which
    Spark still aggregates by hashing (a struct key would force a sort). Rows
    without a date come last. A sequence number or a time of day that does not
    fit the packing fails the job rather than misordering rows.
    """
    if spec.seq_col:
        seq = F.coalesce(F.col(spec.seq_col).cast("bigint"), F.lit(0))
    else:
        content = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        seq = F.shiftrightunsigned(content, 64 - SEQ_BITS)
    if not spec.date_col:
        return seq
    date = F.col(spec.date_col)
    if spec.date_unit == "micro":
        instant = F.coalesce(date.cast("timestamp"), F.lit(LAST_DAY).cast("timestamp"))
        step = F.expr("20000000000000000000BD")     # above the span of a bigint
        return ((F.unix_micros(instant).cast("decimal(20,0)") * step).cast("decimal(38,0)")
                + seq.cast("decimal(20,0)")).cast("decimal(38,0)")
    if spec.date_unit != "day":
        raise ValueError(f"date_unit must be 'day' or 'micro', not {spec.date_unit!r}")
    fits = (seq >= 0) & (seq < SEQ_SPAN)
    kind = df.schema[spec.date_col].dataType
    if isinstance(kind, T.StringType):
        fits = fits & F.coalesce(F.length(date) <= len(LAST_DAY), F.lit(True))
    elif not isinstance(kind, T.DateType):
        fits = fits & F.coalesce(date == F.date_trunc("day", date), F.lit(True))
    day = F.coalesce(date.cast("date"), F.lit(LAST_DAY).cast("date"))
    packed = F.unix_date(day).cast("bigint") * SEQ_SPAN + seq
    return F.when(fits, packed).otherwise(F.raise_error(F.lit(
        "order key does not fit days and a 40-bit sequence: use date_unit='micro'"))
        .cast("bigint"))


def _number_sums(a: str) -> list[str]:
    """Aggregates of one number column.

    ``last`` is the value at the greatest key among rows that have one; its
    filter clause lets generated code skip the update for a missing value.
    """
    return [f"avg({a}) AS {a}_mean", f"max({a}) AS {a}_max",
            f"max_by({a}, key) FILTER (WHERE {a} IS NOT NULL) AS {a}_last"]


def _category_sums(a: str, levels: list[str]) -> list[str]:
    """Aggregates of one category column, given as level codes."""
    counts = [f"count_if({a} = {code}) AS {a}_{code}" for code in range(len(levels))]
    return [*counts, f"max_by({a}, key) AS {a}_last"]


def _batches(groups: dict[str, list[str]], limit: int | None) -> list[list[str]]:
    """Columns in order, a new batch whenever the next would pass ``limit`` aggregates."""
    batches, size = [[]], 0
    for column, parts in groups.items():
        if limit and size and size + len(parts) > limit:
            batches.append([])
            size = 0
        batches[-1].append(column)
        size += len(parts)
    return batches


def _gathered(rows: DataFrame, cut_longs: bool = False) -> DataFrame:
    """The same rows, those of an id side by side, in partitions of bounded size.

    The partitions come from a rebalance, which cuts the one of a hot id into several; so a
    task's partial rows take memory by its partition's ids, not by the split of a file. It goes
    by a hash of the id: by the id itself, Spark would leave out the exchange behind the
    partials, and could not cut. With ``cut_longs`` bigints travel as arrays of their ``PLANES``:
    like bits lie side by side, and the zeros of small numbers compress away.
    """
    longs = [f.name for f in rows.schema.fields
             if cut_longs and isinstance(f.dataType, T.LongType) and f.name not in ("id", "key")]

    def cut(c: str, low: int, bits: int, kind: str) -> Column:
        return F.shiftright(F.shiftleft(F.col(c), 64 - low - bits), 64 - bits).cast(kind)

    def restored(i: int) -> Column:
        parts = [F.shiftleft(F.get(F.col(f"bits{low}"), F.lit(i)).cast("bigint")
                             .bitwiseAND(F.lit((1 << bits) - 1)), low) for low, bits, _ in PLANES]
        return reduce(Column.bitwiseOR, parts)

    arrays = [F.array(*[cut(c, low, bits, kind) for c in longs]).alias(f"bits{low}")
              for low, bits, kind in PLANES if longs]
    moved = rows.select(*[c for c in rows.columns if c not in longs], *arrays,
                        F.hash("id").alias("place")).hint("rebalance", "place")
    back = {c: restored(i).alias(c) for i, c in enumerate(longs)}
    return moved.select(*[back.get(c, F.col(c)) for c in rows.columns])


def collapse(df: DataFrame, spec: EntitySpec, vocabulary: Vocabulary,
             value_type: str = "float", code_type: str = "tinyint",
             batch: int | None = None) -> DataFrame:
    """One row per entity: mean, max, last, diff per number; shares and last code per category.

    ``last`` of a number is its last present value, ``last`` of a category is
    the code of the final row, where missing is a level like any other. Results
    are computed in double precision and narrowed once to ``value_type``.

    With ``batch``, a wide table is collapsed that many aggregates at a time, so
    that each aggregate stays within compiled code: about 1.8 times the steady
    throughput at 40 columns. A batch reads only its own columns and the batches,
    all partitioned by id, join without another shuffle of them. Without a
    ``seq_col`` the order key depends on every column: the rows are then written
    once with their key, gathered by id, and the batches read from there. With ``batch`` every row
    must have an id, whatever the width. Use it on tables read from files: any
    other plan is run once per batch. Streams need the single aggregate.
    """
    spec.require(df.columns)
    numeric = spec.numeric_cols(df.columns)
    names = feature_names(numeric, vocabulary)
    types = {f.name: f.dataType for f in df.schema.fields}
    if any(len(levels) > 127 for levels in vocabulary.values()) and code_type == "tinyint":
        code_type = "int"

    # Positional names keep any column name, dots included, out of expressions.
    num_alias = {c: f"n{i}" for i, c in enumerate(numeric)}
    cat_alias = {c: f"c{i}" for i, c in enumerate(vocabulary)}
    inputs = {a: present(F.col(_quoted(c)), types[c]).alias(a) for c, a in num_alias.items()}
    inputs |= {a: level_code(F.col(_quoted(c)), types[c], vocabulary[c], spec.missing_level).alias(a)
               for c, a in cat_alias.items()}
    sums = {a: _number_sums(a) for a in num_alias.values()}
    sums |= {a: _category_sums(a, vocabulary[c]) for c, a in cat_alias.items()}

    entity = F.col(_quoted(spec.id_col)).alias("id")
    # Never null: one check less per update.
    key = F.coalesce(order_key(df, spec), F.lit(0)).alias("key")
    batches = _batches(sums, batch)
    coded = df.select(entity, key, *inputs.values())
    if batch:
        coded = coded.withColumn("id", F.when(F.col("id").isNotNull(), F.col("id")).otherwise(
            F.raise_error(F.lit("statements without an id")).cast(types[spec.id_col])))
    wide = not df.isStreaming and max(sum(len(sums[c]) for c in b) for b in batches) > NARROW_AGGREGATES
    if len(batches) > 1 and not spec.seq_col:
        path = scratch_path(df.sparkSession, "keyed-statements")
        _gathered(coded, cut_longs=True).write.parquet(path)
        coded, wide = df.sparkSession.read.parquet(path), False     # the files hold them side by side
    grouped = None
    for columns in batches:
        rows = coded.select("id", "key", *columns)
        rows = _gathered(rows) if wide else rows
        counted = ["count(*) AS n_rows"] if grouped is None else []
        part = rows.groupBy("id").agg(
            *[F.expr(e) for e in (counted + [e for c in columns for e in sums[c]] or ["count(*)"])])
        grouped = part if grouped is None else grouped.join(part, "id")

    def narrow(value: str, kind: str, place: int) -> str:
        return f"CAST({value} AS {kind}) AS {_quoted(names[place])}"

    features = []
    for a in num_alias.values():
        last = f"CAST({a}_last AS double)"
        for value in (f"{a}_mean", f"{a}_max", last, f"{last} - {a}_mean"):
            features.append(narrow(value, value_type, len(features)))
    for c, a in cat_alias.items():
        for code in range(len(vocabulary[c])):
            features.append(narrow(f"{a}_{code} / n_rows", value_type, len(features)))
    for a in cat_alias.values():
        features.append(narrow(f"{a}_last", code_type, len(features)))
    return grouped.selectExpr(f"id AS {_quoted(spec.id_col)}", *features)


def numeric_features(df: DataFrame, spec: EntitySpec, value_type: str = "double") -> DataFrame:
    """The number part of a collapse alone."""
    kept = df.drop(*spec.cat_cols)
    return collapse(kept, replace(spec, cat_cols=()), {}, value_type)


def category_features(df: DataFrame, spec: EntitySpec, vocabulary: Vocabulary,
                      value_type: str = "double") -> DataFrame:
    """The category part of a collapse alone; number columns are never read."""
    kept = df.select(spec.id_col, *spec.order_cols, *spec.cat_cols)
    return collapse(kept, spec, vocabulary, value_type)


def _quoted(name: str) -> str:
    return f"`{name}`"
