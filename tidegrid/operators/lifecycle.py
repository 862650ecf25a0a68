"""State logs: latest known fields per key, transitions, issues, upserts, incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(log: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """One row a key: the last known value of every field, and how many entries it has.

    ``max_by`` over (order, value) is a partial aggregate, so a key with very many entries is combined map-side.
    """
    rank = F.struct(*order)
    return log.groupBy(key).agg(*[F.max_by(F.col(f), F.when(F.col(f).isNotNull(), rank)).alias(f) for f in fields], F.count("*").alias("entries"))


def upsert(old: DataFrame, new: DataFrame, on: list[str], keep_if_blank: list[str]) -> DataFrame:
    """New rows win by key; blank fields of a new row keep the stored value."""
    o, n = old.alias("o"), new.alias("n")
    cond = None
    for c in on:
        e = F.col(f"o.{c}") == F.col(f"n.{c}")
        cond = e if cond is None else cond & e
    known = lambda c: F.nullif(F.col(f"n.{c}"), F.lit("")) if c in keep_if_blank else F.col(f"n.{c}")
    new_row = F.col(f"n.{on[0]}").isNotNull()
    cols = [F.when(new_row, F.coalesce(known(c), F.col(f"o.{c}")) if c in keep_if_blank else known(c)).otherwise(F.col(f"o.{c}")).alias(c) if c not in on else F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in old.columns]
    return o.join(n, cond, "full_outer").select(*cols)


def next_state(state: Column, event: Column, attempts: Column, most: int) -> Column:
    """Retry policy: a failure is tried again until ``most`` attempts, too large work is split, the rest follows the event."""
    return F.when(event == "done", "COMPLETED").when((event == "too_large"), "SPLIT").when((event == "failed") & (attempts < most), "PENDING").when(event == "failed", "FAILED").when(event == "started", "RUNNING").otherwise(state)


def issues(expected: DataFrame, actual: DataFrame, on: list[str], value: str, least: float) -> DataFrame:
    """(keys, issue): what is expected but absent, and what is present but too low."""
    missing = expected.select(*on).distinct().join(actual, on, "left_anti").select(*on, F.lit("missing").alias("issue"))
    return missing.unionByName(actual.where(F.col(value) < least).select(*on, F.lit("low").alias("issue")))


def newer(rows: DataFrame, known: DataFrame, on: str, order: str) -> DataFrame:
    """Rows after the last known one of their key; keys never seen count whole."""
    last = known.groupBy(on).agg(F.max(order).alias("_last"))
    return rows.join(last, on, "left").where(F.col("_last").isNull() | (F.col(order) > F.col("_last"))).drop("_last")


def greedy_batches(df: DataFrame, group: list[str], order: list[str], weight: str, most: float, most_rows: int | None = None) -> DataFrame:
    """Batch numbers from 0: a batch closes before the row that would take it over ``most`` or over ``most_rows`` rows.

    A row that weighs more than ``most`` is a batch of its own.  The fold runs over rows sorted within partitions, one
    group after another, and keeps two numbers; so no group is held in memory.
    """

    def fold(batches):
        last, held, rows, number = None, 0.0, 0, 0
        for b in batches:
            out = []
            for g, w in zip(zip(*(b[c] for c in group), strict=True), b[weight], strict=True):
                if g != last:
                    last, held, rows, number = g, 0.0, 0, 0
                elif held + w > most or (most_rows is not None and rows >= most_rows):
                    held, rows, number = 0.0, 0, number + 1
                held, rows = held + w, rows + 1
                out.append(number)
            yield b.assign(batch=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", batch int"
    return df.repartition(*group).sortWithinPartitions(*group, *order).mapInPandas(fold, schema)


def replay(lines: DataFrame, snapshot: DataFrame | None, key: str, fields: dict[str, str], text: str = "value", place: str = "seq") -> DataFrame:
    """A table from its snapshot and the journal written since: each line is a JSON object that changes only the fields it
    names; a torn line, which is no whole object, is ignored.

    ``place`` orders the lines; the snapshot comes before all of them.
    """
    schema = ", ".join([f"{key} string", *(f"{n} {t}" for n, t in fields.items())])
    whole = F.col(text).rlike(r"^\s*\{.*\}\s*$") & F.try_parse_json(F.col(text)).isNotNull()
    log = lines.where(whole).select(F.col(place).alias("_at"), F.from_json(text, schema).alias("j")).select("_at", "j.*").where(F.col(key).isNotNull())
    if snapshot is not None:
        log = snapshot.select(F.lit(-1).cast("long").alias("_at"), key, *fields).unionByName(log)
    return latest(log, key, ["_at"], list(fields)).drop("entries")


def claim(table: DataFrame, wanted: DataFrame, key: str, state: str, expected: list[str], to: str) -> DataFrame:
    """Compare and set: (key, granted) for each wanted row; granted where the row is in an expected state. Of several
    claims of one row the first by ``claimant`` wins."""
    own = wanted.groupBy(key).agg(F.min("claimant").alias("_first"))
    got = wanted.join(own, key).join(table.select(key, F.col(state).alias("_s")), key, "left")
    granted = F.coalesce(F.col("_s").isin(*expected) & (F.col("claimant") == F.col("_first")), F.lit(False))
    return got.select(key, "claimant", granted.alias("granted"), F.when(granted, F.lit(to)).otherwise(F.col("_s")).alias(state))


def work_list(tracks: DataFrame, chunks: DataFrame, uncovered: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Every track and chunk that is covered and not yet known. The product is the work itself; neither side need be short."""
    return chunks.crossJoin(tracks).join(uncovered, on, "left_anti").join(known, on, "left_anti")


def confirm(table: DataFrame, scope: Column, state: str, before: str, after: str) -> DataFrame:
    """Rows of the scope move on from one state; all others stay."""
    return table.withColumn(state, F.when(scope & (F.col(state) == before), F.lit(after)).otherwise(F.col(state)))


def in_scope(table: DataFrame, state: str, left_out: list[str], parent: str, key: str) -> DataFrame:
    """Rows that count: none of the states left out, and no row that others name as their parent."""
    split = table.where(F.col(parent).isNotNull()).select(F.col(parent).alias(key)).distinct()
    return table.where(~F.col(state).isin(*left_out)).join(split, key, "left_anti")


def require_decisions(found: DataFrame, accepted: DataFrame, on: list[str]) -> DataFrame:
    """The issues, if every one is accepted; otherwise an error that names some."""
    open_ = found.join(accepted, on, "left_anti").limit(5).collect()
    if open_:
        raise ValueError(f"undecided: {[tuple(r[c] for c in on) for r in open_]}")
    return found


def pin(current: DataFrame, wanted: DataFrame, name: str, version: str, replace: bool = False) -> DataFrame:
    """Pointers (name, version): new names are added; a pinned one moves only with ``replace``."""
    both = current.select(name, F.col(version).alias("_old")).join(wanted.select(name, F.col(version).alias("_new")), name, "full_outer")
    return both.select(name, (F.coalesce("_new", "_old") if replace else F.coalesce("_old", "_new")).alias(version))


def refuse_new_dates(rows: DataFrame, frozen: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is among the frozen inputs, and those that came later and are left out."""
    return rows.join(frozen, on, "left_semi"), rows.join(frozen, on, "left_anti")


def stage_of(table: DataFrame, steps: list[tuple[str, Column]], done: str) -> DataFrame:
    """The first step that is not finished names the stage."""
    out = F.lit(done)
    for name, finished in reversed(steps):
        out = F.when(~F.coalesce(finished, F.lit(False)), F.lit(name)).otherwise(out)
    return table.withColumn("stage", out)
