"""Keep-last accumulation and change classification (U-01..U-09, W-01..W-04, J-01..J-06).

Core plan — one shuffle on the key
----------------------------------
Previous rows are tagged ``src = 0`` and batch rows ``src = 1``; both are
unioned by name and grouped by the key::

    groupBy(key).agg(max(when(src = 1, struct(src, ord, *cols)))   -- newest batch row
                     max(when(src = 0, struct(src, ord, *cols))))  -- newest previous row
    keep-last = coalesce(newest batch row, newest previous row)

``max`` of a struct compares field by field, so ``(src, ord)`` decides which
row is "last" and the remaining fields only break exact ties.  That makes the
result a *total* order per key — identical for any partitioning or file split.
Because this is an aggregate, Spark runs a partial (map-side) aggregate before
the exchange: a key that holds a third of all rows is collapsed to one row per
map task before anything is shuffled, so no reducer ever receives a hot
group.  ``change_type`` is then derived per key:

* no previous row                                → ``new``
* previous row equal (null-safe, 6-dp tolerant)  → ``unchanged``
* otherwise                                      → ``edited``

Touched-only plan — for stored tables that are already unique by key
--------------------------------------------------------------------
When the previous table is known to hold one row per key (every table written
by :mod:`snapmerge.sources.store` does) and the batch's distinct keys are
*proven* small, the keys are broadcast and the previous table is split with
two broadcast hash joins: untouched rows pass through unchanged without any
shuffle, and only the touched rows plus the batch go through the aggregate.
At 100 TB this keeps the shuffle proportional to the extract, not the history.

Lookup plan — when the collapsed batch rows are proven small as well
--------------------------------------------------------------------
The batch is collapsed per key first (the only shuffle), its rows are
broadcast, and each stored row looks its key up in a single scan; new keys are
the collapsed batch minus the keys a key-only scan finds in the stored table.
The history is then read once in full instead of twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import qcol, quote, rows_equal, values_equal
from .sizing import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, bounded_count,
                     known_rows, measured_bytes, most_rows, proven_rows, with_known_rows)

SRC = "_sm_src"
ORD = "_sm_ord"
LAST = "_sm_last"
PREV = "_sm_prev"
_BATCH_LAST = "_sm_batch_last"
CHANGE = "change_type"
NEW, EDITED, UNCHANGED = "new", "edited", "unchanged"

# Output of the order-aware variants: (src, ord) of the surviving row and of
# the key's first appearance.
LAST_SRC, LAST_ORD = "last_src", "last_ord"
SEEN_SRC, SEEN_ORD = "seen_src", "seen_ord"

# Persistent first-seen stamps (O-03 across runs): when present in the stored
# table they are always taken from the previous row and never compared.
STAMP_RUN, STAMP_ORD = "first_seen_run", "first_seen_ord"
STAMPS = (STAMP_RUN, STAMP_ORD)


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def tag(df: DataFrame, src: int, ord_col: str | None = None, seq_col: str | None = None) -> DataFrame:
    """Add the source tag and the within-source order used by keep-last.

    A side that lacks the order column (e.g. a stored table written before the
    column existed) gets order 0: the source tag alone decides between sides.
    """
    ord_expr = qcol(ord_col).cast("long") if ord_col and ord_col in df.columns else F.lit(0).cast("long")
    src_expr = F.lit(src)
    if src > 0 and seq_col and seq_col in df.columns:
        # several runs in one batch: the run sequence (e.g. the extract's epoch,
        # always > 0) orders them; every batch row still outranks src = 0
        src_expr = F.greatest(F.coalesce(qcol(seq_col).cast("long"), F.lit(1).cast("long")),
                              F.lit(1).cast("long"))
    return df.withColumn(SRC, src_expr).withColumn(ORD, ord_expr)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """U-01: union by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (SRC, ORD)]


def _packed(value_cols: Sequence[str]) -> Column:
    return F.struct(F.col(SRC).alias(SRC), F.col(ORD).alias(ORD),
                    *[qcol(c).alias(c) for c in value_cols])


def _collapse(tagged: DataFrame, keys: list[str], with_prev: bool) -> DataFrame:
    """Group a tagged union by key; keep the newest row (and newest previous row).

    With ``with_prev`` the batch side and the previous side are aggregated into
    separate buffers, and keep-last is ``coalesce(batch_last, prev_last)`` —
    equal to ``max`` over both because every batch row outranks every previous
    row (``src`` 1 > 0).  Each input row then feeds exactly one buffer, so a
    stored row is shuffled once, not twice.
    """
    cols = _data_columns(tagged)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"key columns not found: {missing}")
    vals = [c for c in cols if c not in keys]
    packed = _packed(vals)
    key_cols = [qcol(k) for k in keys]
    if not with_prev:
        return tagged.groupBy(*key_cols).agg(F.max(packed).alias(LAST))
    g = tagged.groupBy(*key_cols).agg(F.max(F.when(F.col(SRC) > 0, packed)).alias(_BATCH_LAST),
                                      F.max(F.when(F.col(SRC) == 0, packed)).alias(PREV))
    return g.select(*key_cols, F.coalesce(F.col(_BATCH_LAST), F.col(PREV)).alias(LAST), F.col(PREV))


def _unpack(grouped: DataFrame, cols: Sequence[str], keys: list[str],
            keep_from_prev: Sequence[str] = ()) -> list[Column]:
    out = []
    for c in cols:
        if c in keys:
            out.append(qcol(c))
        elif c in keep_from_prev:
            out.append(F.coalesce(F.col(PREV).getField(c), F.col(LAST).getField(c)).alias(c))
        else:
            out.append(F.col(LAST).getField(c).alias(c))
    return out


def _compare_fields(tagged: DataFrame, keys: list[str], exclude: Sequence[str]) -> list[tuple[str, T.DataType]]:
    types = {f.name: f.dataType for f in tagged.schema.fields}
    return [(c, types[c]) for c in _data_columns(tagged) if c not in keys and c not in exclude]


def _change_type(fields: list[tuple[str, T.DataType]]) -> Column:
    return (F.when(F.col(PREV).isNull(), F.lit(NEW))
            .when(rows_equal(LAST, PREV, fields), F.lit(UNCHANGED))
            .otherwise(F.lit(EDITED)))


def _order_columns() -> list[Column]:
    first = F.coalesce(F.col(PREV), F.col(LAST))
    return [F.col(LAST).getField(SRC).alias(LAST_SRC), F.col(LAST).getField(ORD).alias(LAST_ORD),
            first.getField(SRC).alias(SEEN_SRC), first.getField(ORD).alias(SEEN_ORD)]


# --------------------------------------------------------------------------- public operators
def keep_last(df: DataFrame, keys: str | Sequence[str], ord_col: str | None = None,
              seq_col: str | None = None) -> DataFrame:
    """W-01/W-02/W-04: one row per key — the one with the greatest ``ord_col``.

    Null keys form one group.  Without ``ord_col`` the tie-break is the row
    content (deterministic, but not file order: read extracts through
    :func:`snapmerge.sources.extract.read_extract`, which supplies the file order).
    """
    keys = _keys(keys)
    tagged = tag(df, 1, ord_col, seq_col)
    cols = _data_columns(tagged)
    g = _collapse(tagged, keys, with_prev=False)
    return g.select(*_unpack(g, cols, keys))


def dedup_full_row(df: DataFrame) -> DataFrame:
    """W-03: whole-row de-duplication (no key configured)."""
    return df.dropDuplicates()


def accumulate(prev: DataFrame | None, batch: DataFrame, keys: str | Sequence[str],
               ord_col: str | None = None, with_order: bool = False, seq_col: str | None = None) -> DataFrame:
    """U-02: union + keep-last; no previous row is ever removed.

    An empty batch returns the previous rows (U-03); a missing previous table
    returns the de-duplicated batch (first run, S-09).
    """
    return accumulate_and_classify(prev, batch, keys, ord_col, with_order=with_order,
                                   classify=False, seq_col=seq_col)


def accumulate_and_classify(prev: DataFrame | None, batch: DataFrame, keys: str | Sequence[str],
                            ord_col: str | None = None, compare_exclude: Sequence[str] = (),
                            with_order: bool = False, classify: bool = True,
                            prev_unique: bool = False, strategy: str = "auto",
                            keep_from_prev: Sequence[str] = (), seq_col: str | None = None,
                            batch_unique: bool = False) -> DataFrame:
    """U-04 (+ J-01, J-06, U-09): accumulated table with a fresh ``change_type``.

    ``strategy``: ``"shuffle"`` always uses the single-aggregate plan;
    ``"auto"`` switches to the touched-only plan when ``prev_unique`` is true,
    the batch's distinct keys are proven small enough to broadcast and the
    stored table is proven several times larger than that key set;
    ``"touched"`` forces it (still requires ``prev_unique``); ``"auto"`` prefers
    the lookup plan (:func:`_lookup`) when the collapsed batch rows fit the
    broadcast bound too, and ``"lookup"`` forces that one.
    ``keep_from_prev``: columns that keep the previous row's value whenever the
    key existed (e.g. columns the batch no longer carries, Q-06); they are not
    compared.  The first-seen stamps (:data:`STAMPS`) always behave this way.
    ``seq_col``: run sequence of batch rows when one batch holds several runs
    (keep-last orders by run, then ``ord_col``); like ``ord_col`` it is not compared.
    ``batch_unique``: the batch is known to hold one row per key (another merge's output), so a first run
    only labels its rows.
    """
    keys = _keys(keys)
    if prev is None and batch_unique:
        return _first_rows(batch, keys, ord_col, with_order, classify, seq_col)
    if prev is None:
        prev = with_known_rows(batch.limit(0), 0)
    present = set(prev.columns) | set(batch.columns)
    keep = list(keep_from_prev) + [s for s in STAMPS if s in present and s not in keep_from_prev]
    exclude = list(compare_exclude) + ([ord_col] if ord_col else []) + ([seq_col] if seq_col else []) + keep
    if prev_unique and strategy in ("auto", "touched", "lookup"):
        batch_keys = batch.select(*[qcol(k) for k in keys]).distinct()
        plan = strategy if strategy != "auto" else _stored_plan(prev, batch, batch_keys, keys, ord_col, seq_col)
        if plan == "lookup":
            return _lookup(prev, batch, batch_keys, keys, ord_col, exclude, with_order, classify, keep, seq_col)
        if plan == "touched":
            return _touched_only(prev, batch, batch_keys, keys, ord_col, exclude, with_order, classify, keep,
                                 seq_col)
    tagged = union_by_name(tag(prev, 0, ord_col), tag(batch, 1, ord_col, seq_col))
    cols = _data_columns(tagged)
    g = _collapse(tagged, keys, with_prev=True)
    out = _unpack(g, cols, keys, keep)
    if classify:
        out.append(_change_type(_compare_fields(tagged, keys, exclude)).alias(CHANGE))
    if with_order:
        out.extend(_order_columns())
    return g.select(*out)


def _first_rows(batch: DataFrame, keys: list[str], ord_col: str | None, with_order: bool, classify: bool,
                seq_col: str | None) -> DataFrame:
    """A first run whose batch holds one row per key: every row is new, nothing is grouped."""
    tagged = tag(batch, 1, ord_col, seq_col)
    cols = _data_columns(tagged)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"key columns not found: {missing}")
    out = [qcol(c) for c in cols]
    if classify:
        out.append(F.lit(NEW).alias(CHANGE))
    if with_order:
        out.extend([F.col(SRC).alias(LAST_SRC), F.col(ORD).alias(LAST_ORD), F.col(SRC).alias(SEEN_SRC), F.col(ORD).alias(SEEN_ORD)])
    return tagged.select(*out)


# The touched-only plan is used when the stored table holds at least this many
# times more rows than the batch has distinct keys.
TOUCHED_RATIO = 4
# The lookup plan adds one broadcast stage and saves one full read of the
# stored table.  Below this many stored rows the extra stage costs more (on
# local[8]: 1.5 s slower on a 49k-row history).  A warm local page cache hides
# the saved read (about 0.25 s slower at 4.8M rows there), so the default is a
LOOKUP_MIN_ROWS = 4_000_000
# Session setting that overrides LOOKUP_MIN_ROWS (e.g. lower on object storage,
# where the second full read of the history costs more than on local disk).
LOOKUP_MIN_ROWS_CONF = "snapmerge.lookupMinRows"


def _lookup_min_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(LOOKUP_MIN_ROWS_CONF, None)
    return LOOKUP_MIN_ROWS if value in (None, "") else int(value)


def _stored_plan(prev: DataFrame, batch: DataFrame, batch_keys: DataFrame, keys: list[str],
                 ord_col: str | None, seq_col: str | None) -> str:
    """Pick the plan for a stored (unique-by-key) previous table.

    Two proofs: the batch's keys fit a broadcast, and the stored table
    is more than ``TOUCHED_RATIO`` times larger (so most of it can skip the
    shuffle).  The stored table's rows are those its commit recorded, where the
    caller passes them on; keys are counted by one aggregate.
    The batch collapses to one row per key, so the key count also bounds the
    collapsed batch.  When those rows are measured to fit the byte bound
    (:func:`_collapsed_batch_fits`) and the stored table is proven to hold over
    ``LOOKUP_MIN_ROWS`` rows (or the session's ``snapmerge.lookupMinRows``),
    ``"lookup"`` broadcasts them whole; otherwise ``"touched"`` broadcasts
    only the keys.

    Keys are not counted where the answer can't change the plan: the stored table is no larger than
    ``TOUCHED_RATIO`` rows, or than that many times the rows the batch has at most (the merge then
    reads about as many batch rows as stored ones).
    """
    stored, most = known_rows(prev), most_rows(batch)
    if stored is not None and stored <= TOUCHED_RATIO * max(most or 1, 1):
        return "shuffle"
    # a batch whose rows are known (a written preview, one row per key) needs no count of its keys
    n_keys = proven_rows(with_known_rows(batch_keys, known_rows(batch)))
    if n_keys is None:
        return "shuffle"
    ratio_rows = TOUCHED_RATIO * max(n_keys, 1)
    n_prev = bounded_count(prev, max(ratio_rows, _lookup_min_rows(prev)))
    if n_prev is not None and n_prev <= ratio_rows:
        return "shuffle"
    if n_prev is None:
        _, b, _ = _aligned_sides(prev, batch, keys, ord_col, seq_col)
        if _collapsed_batch_fits(b, n_keys):
            return "lookup"
    return "touched"


def _collapsed_batch_fits(b: DataFrame, n_keys: int) -> bool:
    """Bound the broadcast of the collapsed batch (``n_keys`` rows, each a subset
    of the batch's rows) by measurement, not by a width estimate.

    Each row holds the key fields and a struct of all fields; a field slot is
    8 bytes plus up to 8 bytes of alignment for variable-length values, and
    the variable-length bytes of all chosen rows are at most those of the whole
    batch, summed in one aggregate pass.  The hashed relation is counted twice.
    Nested columns have no such bound, so they never take this plan.
    """
    fields = b.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in fields):
        return False
    n_var = sum(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in fields)
    if 2 * n_keys * 8 * (2 * len(fields) + 4 + n_var) > DEFAULT_MAX_BROADCAST_BYTES:
        return False       # slots alone are too big: skip the measuring pass
    # a collapsed row = key slots + a struct of every field; measured_bytes
    # covers one copy of every field and the batch's variable-length bytes
    size = measured_bytes(b, n_keys)
    return size is not None and 2 * (size + n_keys * 8 * (len(fields) + 2)) <= DEFAULT_MAX_BROADCAST_BYTES


def _aligned_sides(prev: DataFrame, batch: DataFrame, keys: list[str], ord_col: str | None,
                   seq_col: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both tagged sides projected to the union's columns and types, and the
    batch collapsed to its newest row per key (``_BATCH_LAST``)."""
    tp, tb = tag(prev, 0, ord_col), tag(batch, 1, ord_col, seq_col)
    schema = union_by_name(tp, tb).schema
    cols = [f.name for f in schema.fields]
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"key columns not found: {missing}")

    def align(df: DataFrame) -> DataFrame:
        return df.select(*[(qcol(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])

    p, b = align(tp), align(tb)
    vals = [c for c in _data_columns(p) if c not in keys]
    collapsed = b.groupBy(*[qcol(k) for k in keys]).agg(F.max(_packed(vals)).alias(_BATCH_LAST))
    return p, b, collapsed


def _null_safe_on(left: DataFrame, right_prefix: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[quote(k)].eqNullSafe(F.col(quote(right_prefix + k))) for k in keys])


def _touched_only(prev: DataFrame, batch: DataFrame, batch_keys: DataFrame, keys: list[str],
                  ord_col: str | None, exclude: list[str], with_order: bool,
                  classify: bool, keep: Sequence[str] = (), seq_col: str | None = None) -> DataFrame:
    prefix = "_sm_bk_"
    bk = F.broadcast(batch_keys.select(*[qcol(k).alias(prefix + k) for k in keys]))
    on = _null_safe_on(prev, prefix, keys)
    touched = prev.join(bk, on, "left_semi")
    untouched = prev.join(bk, on, "left_anti")
    tagged = union_by_name(tag(touched, 0, ord_col), tag(batch, 1, ord_col, seq_col))
    cols = _data_columns(tagged)
    g = _collapse(tagged, keys, with_prev=True)
    out = _unpack(g, cols, keys, keep)
    if classify:
        out.append(_change_type(_compare_fields(tagged, keys, exclude)).alias(CHANGE))
    if with_order:
        out.extend(_order_columns())
    merged = g.select(*out)
    rest = untouched
    for c in cols:
        if c not in rest.columns:
            rest = rest.withColumn(c, F.lit(None).cast(dict(tagged.dtypes)[c]))
    if classify:
        rest = rest.withColumn(CHANGE, F.lit(UNCHANGED))
    if with_order:
        o = qcol(ord_col).cast("long") if ord_col and ord_col in untouched.columns else F.lit(0).cast("long")
        rest = (rest.withColumn(LAST_SRC, F.lit(0)).withColumn(LAST_ORD, o)
                .withColumn(SEEN_SRC, F.lit(0)).withColumn(SEEN_ORD, o))
    return merged.unionByName(rest.select(*merged.columns))


def _lookup(prev: DataFrame, batch: DataFrame, batch_keys: DataFrame, keys: list[str],
            ord_col: str | None, exclude: list[str], with_order: bool,
            classify: bool, keep: Sequence[str] = (), seq_col: str | None = None) -> DataFrame:
    """Stored table unique by key, collapsed batch proven small.

    The batch alone is shuffled (to collapse it per key); its newest rows are
    broadcast and every stored row looks its key up in one scan, so stored rows
    are neither shuffled nor read in full twice.  New keys are the collapsed
    batch minus the touched keys, found by a key-only scan of the stored table.
    """
    p, _, collapsed = _aligned_sides(prev, batch, keys, ord_col, seq_col)
    cols = _data_columns(p)
    vals = [c for c in cols if c not in keys]
    prefix = "_sm_bk_"
    looked_up = p.join(F.broadcast(collapsed.select(*[qcol(k).alias(prefix + k) for k in keys], _BATCH_LAST)),
                       _null_safe_on(p, prefix, keys), "left_outer")
    # stored rows without a batch row pass through as plain columns; fields are
    # read from the batch row (and compared) only on a hit, so no struct is
    # built per stored row
    hit = F.col(_BATCH_LAST).isNotNull()
    newer = F.col(_BATCH_LAST)
    out = []
    for c in cols:
        if c in keys:
            out.append(qcol(c))
        elif c in keep:
            out.append(F.coalesce(qcol(c), F.when(hit, newer.getField(c))).alias(c))
        else:
            out.append(F.when(hit, newer.getField(c)).otherwise(qcol(c)).alias(c))
    if classify:
        same = reduce(lambda a, b: a & b,
                      [values_equal(newer.getField(c), qcol(c), t) for c, t in _compare_fields(p, keys, exclude)],
                      F.lit(True))
        out.append(F.when(~hit | same, F.lit(UNCHANGED)).otherwise(F.lit(EDITED)).alias(CHANGE))
    if with_order:
        out.extend([F.when(hit, newer.getField(SRC)).otherwise(F.col(SRC)).alias(LAST_SRC),
                    F.when(hit, newer.getField(ORD)).otherwise(F.col(ORD)).alias(LAST_ORD),
                    F.col(SRC).alias(SEEN_SRC), F.col(ORD).alias(SEEN_ORD)])
    old_keys = looked_up.select(*out)
    bk = F.broadcast(batch_keys.select(*[qcol(k).alias(prefix + k) for k in keys]))
    touched = p.select(*[qcol(k) for k in keys])
    touched = touched.join(bk, _null_safe_on(touched, prefix, keys), "left_semi")
    hit = "_sm_hit"
    touched = F.broadcast(touched.select(*[qcol(k).alias(prefix + k) for k in keys], F.lit(True).alias(hit)))
    prev_type = collapsed.schema[_BATCH_LAST].dataType
    # an outer join + null test rather than an anti join: Catalyst would push an
    # anti join below the batch aggregate and aggregate the batch a second time;
    # this way both uses share one exchange of the batch (ReusedExchange)
    new_keys = (collapsed.join(touched, _null_safe_on(collapsed, prefix, keys), "left_outer")
                .where(F.col(hit).isNull())
                .select(*[qcol(k) for k in keys], F.col(_BATCH_LAST).alias(LAST),
                        F.lit(None).cast(prev_type).alias(PREV)))
    out = _unpack(new_keys, cols, keys, keep)
    if classify:
        out.append(F.lit(NEW).alias(CHANGE))
    if with_order:
        out.extend(_order_columns())
    return old_keys.unionByName(new_keys.select(*out))


def classify_changes(final: DataFrame, prev: DataFrame | None, keys: str | Sequence[str],
                     ord_col: str | None = None, compare_exclude: Sequence[str] = ()) -> DataFrame:
    """J-01: label each row of ``final`` against the previous snapshot.

    Key absent in ``prev`` → ``new``; present and some column differs →
    ``edited``; otherwise ``unchanged``.  A previous snapshot with duplicate
    keys is read last-wins (J-06).  Rows of ``prev`` whose key is not in
    ``final`` are not returned.
    """
    keys = _keys(keys)
    exclude = list(compare_exclude) + ([ord_col] if ord_col else [])
    if prev is None:
        prev = final.limit(0)
    tagged = union_by_name(tag(prev, 0, ord_col), tag(final, 1, ord_col))
    cols = [c for c in _data_columns(tagged) if c in final.columns]
    g = (_collapse(tagged, keys, with_prev=True)
         .where(F.col(LAST).getField(SRC) > 0))
    return g.select(*_unpack(g, cols, keys),
                    _change_type(_compare_fields(tagged, keys, exclude)).alias(CHANGE))


def count_new_keys(final: DataFrame, prev: DataFrame | None, keys: str | Sequence[str],
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """J-02 / U-07: number of distinct keys of ``final`` absent from ``prev``.

    When ``final``'s distinct keys are proven small, they are broadcast and a
    key-only scan of ``prev`` finds the ones already seen (broadcast semi join,
    no shuffle of ``prev``); the rest are new.  Otherwise one aggregate over the
    tagged key union (partial aggregation before the shuffle).  No previous
    table → every distinct key is new (Q-16).  Null keys count as one key.
    """
    keys = _keys(keys)
    distinct_keys = final.select(*[qcol(k) for k in keys]).distinct()
    if prev is not None:
        limit = DEFAULT_MAX_BROADCAST_ROWS if max_broadcast_rows is None else max_broadcast_rows
        if proven_rows(distinct_keys, limit) is not None:
            return _count_unseen(distinct_keys, prev, keys)
    kf = final.select(*[qcol(k) for k in keys]).withColumn(SRC, F.lit(1))
    if prev is None:
        u = kf
    else:
        u = kf.unionByName(prev.select(*[qcol(k) for k in keys]).withColumn(SRC, F.lit(0)))
    per_key = u.groupBy(*[qcol(k) for k in keys]).agg(
        F.max(F.col(SRC) == 1).alias("_in_final"), F.max(F.col(SRC) == 0).alias("_in_prev"))
    return per_key.agg(F.count_if(F.col("_in_final") & ~F.col("_in_prev")).alias("new_keys"))


def _count_unseen(distinct_keys: DataFrame, prev: DataFrame, keys: list[str]) -> DataFrame:
    prefix, hit = "_sm_bk_", "_sm_hit"
    pk = prev.select(*[qcol(k) for k in keys])
    bk = F.broadcast(distinct_keys.select(*[qcol(k).alias(prefix + k) for k in keys]))
    seen = pk.join(bk, _null_safe_on(pk, prefix, keys), "left_semi").distinct()
    seen = F.broadcast(seen.select(*[qcol(k).alias(prefix + k) for k in keys], F.lit(True).alias(hit)))
    return (distinct_keys.join(seen, _null_safe_on(distinct_keys, prefix, keys), "left_outer")
            .where(F.col(hit).isNull())
            .agg(F.count(F.lit(1)).alias("new_keys")))


def split_by_change(classified: DataFrame) -> dict[str, DataFrame]:
    """J-04: separate ``new`` / ``edited`` / ``unchanged`` outputs."""
    return {t: classified.where(F.col(CHANGE) == t) for t in (NEW, EDITED, UNCHANGED)}


def change_summary(classified: DataFrame) -> DataFrame:
    """A-10: counts per change type in one aggregate (new + edited exposed separately)."""
    ct = F.col(CHANGE)
    return classified.agg(
        F.count_if(ct == NEW).alias("new_rows"),
        F.count_if(ct == EDITED).alias("edited_rows"),
        F.count_if(ct == UNCHANGED).alias("unchanged_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
