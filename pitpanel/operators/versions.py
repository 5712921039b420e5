"""Which version of a revisable row counts: newest, visible at an instant, or blocked by a conflict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def as_of_newest(df: DataFrame, key: list[str], at: str, cutoff: Column, valid: Column, tie: str) -> DataFrame:
    """The newest row at or before the cutoff, and whether it is valid; an older valid row never stands in."""
    return newest(df.where(F.col(at) <= cutoff), key, [F.col(at).desc(), F.col(tie).desc()]).withColumn("valid", F.coalesce(valid, F.lit(False)))


def visible_versions(df: DataFrame, key: list[str], announced: str, updated: str, fetched: str, values: list[str], cutoff: Column, tie: str) -> DataFrame:
    """One row for each key with state: chosen, unknown_fetch or conflict (then without values).

    Of the versions announced (and updated, if known) by the cutoff, the leading ones by (announced,
    updated with null lowest, fetched) count. A version without a fetch time blocks its key; leading
    versions that differ in a value drop it.
    """
    seen = df.where((F.col(announced) <= cutoff) & (F.col(updated).isNull() | (F.col(updated) <= cutoff)))
    order = [F.col(announced).desc(), F.col(updated).desc_nulls_last(), F.col(fetched).desc()]
    rows = seen.withColumn("_r", F.rank().over(Window.partitionBy(*key).orderBy(*order))).withColumn("_blocked", F.max(F.col(fetched).isNull()).over(Window.partitionBy(*key)))
    whole = F.struct(*(F.col(v) for v in values))
    best = rows.groupBy(*key).agg(F.max("_blocked").alias("blocked"), F.max(F.when(F.col("_r") == 1, F.struct(F.col(tie).alias("tie"), whole.alias("v")))).alias("top"), *(F.min(F.when(F.col("_r") == 1, F.col(v))).alias(f"lo_{v}") for v in values), *(F.max(F.when(F.col("_r") == 1, F.col(v))).alias(f"hi_{v}") for v in values))
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(f"lo_{v}").eqNullSafe(F.col(f"hi_{v}"))
    state = F.when(F.col("blocked"), "unknown_fetch").when(differs, "conflict").otherwise("chosen")
    picked = best.withColumn("state", state)
    return picked.select(*key, "state", F.when(F.col("state") == "chosen", F.col("top.tie")).alias(tie), *(F.when(F.col("state") == "chosen", F.col(f"top.v.{v}")).alias(v) for v in values))


def unique_winner(df: DataFrame, key: list[str], kind: list[str], order: list[Column]) -> DataFrame:
    """The leading row of each key with state: chosen, mixed_kind (several parser or mapping kinds) or tie."""
    mixed = F.size(F.collect_set(F.struct(*kind)).over(Window.partitionBy(*key))) > 1
    rows = df.withColumn("_r", F.rank().over(Window.partitionBy(*key).orderBy(*order))).withColumn("_mixed", mixed).where("_r = 1")
    rows = rows.withColumn("_ties", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    rows = rows.withColumn("state", F.when(F.col("_mixed"), "mixed_kind").when(F.col("_ties") > 1, "tie").otherwise("chosen"))
    return rows.dropDuplicates(key).drop("_r", "_mixed", "_ties")


def requested(wanted: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Every requested key, with nulls and present = false where nothing was found."""
    return wanted.select(*key).distinct().join(found.withColumn("present", F.lit(True)), key, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def leading_context(df: DataFrame, key: list[str], order: list[Column], wanted: DataFrame | None = None) -> DataFrame:
    """Each key's leading row with context_state: chosen, tie (several rows lead alike, none is shown) or, for wanted keys without a row, absent.

    ``order`` goes from the most to the least important, the largest leads, null lowest. Equal rows are counted before they meet.
    """
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*(F.struct(o.isNotNull().alias("k"), o.alias("v")).alias(f"o{i}") for i, o in enumerate(order)))
    alike = df.withColumn("_o", rank).groupBy(*key, "_o").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_r"))
    best = alike.groupBy(*key).agg(F.max_by(F.struct("_n", "_r"), "_o").alias("b"))
    chosen = F.col("b._n") == 1
    out = best.select(*key, *(F.when(chosen, F.col(f"b._r.{c}")).alias(c) for c in rest), F.when(chosen, "chosen").otherwise("tie").alias("context_state"))
    if wanted is None:
        return out
    return wanted.select(*key).distinct().join(out, key, "left").withColumn("context_state", F.coalesce("context_state", F.lit("absent")))


def leading_versions(df: DataFrame, key: list[str], published: str, updated: str, precision: str, generation: str, content: str) -> DataFrame:
    """(key, state, published, updated, generation, content): each key's leading version under an order that is only partial.

    A version's instant is ``updated``, or ``published`` where no version states an update. The later one leads, and several may lead
    together if they are the same in generation and content. state names the first thing that forbids a choice: incomparable (two contents
    with different precision, or of which one states an update and one doesn't), contradictory (one was published earlier and
    updated later than another), different_content (two contents lead at one instant), else chosen.

    No pairs are made: what all pairs would show follows from the key's different contents, from one sort by instant with the
    published times before it, and from the leading instant.
    """
    same = F.struct(generation, content)
    rows = df.select(*key, published, updated, precision, generation, content, same.alias("_same"), F.coalesce(updated, published).alias("_at")).distinct()
    # Of two different contents one side decides whether they compare; a content may state both, so each kind's contents are counted.
    kind = F.struct(F.col(precision), F.col(updated).isNotNull())
    kinds = rows.groupBy(*key).agg(F.countDistinct(kind).alias("kinds"), F.countDistinct("_same").alias("contents"))
    # Rows in order of their instants: a later instant with an earlier publication than one that went before contradicts it.
    instants = rows.groupBy(*key, kind.alias("_kind"), "_at").agg(F.min(published).alias("_first"), F.max(published).alias("_last"))
    before = F.max("_last").over(Window.partitionBy(*key, "_kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    crossed = instants.withColumn("_crossed", F.col("_first") < before).groupBy(*key).agg(F.bool_or(F.coalesce("_crossed", F.lit(False))).alias("crossed"))
    top = rows.groupBy(*key, "_at").agg(F.countDistinct("_same").alias("leading"), F.min(F.struct(generation, content, published, updated)).alias("b")).groupBy(*key).agg(F.max_by(F.struct("leading", "b"), "_at").alias("t"))
    both = kinds.join(crossed, key).join(top, key)
    state = F.when((F.col("kinds") > 1) & (F.col("contents") > 1), "incomparable").when(F.col("crossed"), "contradictory").when(F.col("t.leading") > 1, "different_content").otherwise("chosen")
    shown = lambda c: F.when(F.col("state") == "chosen", F.col(f"t.b.{c}")).alias(c)
    return both.withColumn("state", state).select(*key, "state", shown(published), shown(updated), shown(generation), shown(content))


def undominated(df: DataFrame, key: list[str], name: str, at_least: list[str]) -> DataFrame:
    """The rows of each key that no other row reaches or passes in all dimensions (and passes in one); groups are small versions lists."""
    x, y = df.alias("x"), df.alias("y")
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
    reach, more = F.lit(True), F.lit(False)
    for d in at_least:
        reach, more = reach & (F.col(f"y.{d}") >= F.col(f"x.{d}")), more | (F.col(f"y.{d}") > F.col(f"x.{d}"))
    return x.join(y, same & (F.col(f"x.{name}") != F.col(f"y.{name}")) & reach & more, "left_anti")


def differences(old: DataFrame, new: DataFrame, key: list[str], hash_col: str) -> DataFrame:
    """(key, change): added, removed or changed rows between two reads of one table."""
    o, n = old.select(*key, F.col(hash_col).alias("_o"), F.lit(True).alias("_in_old")), new.select(*key, F.col(hash_col).alias("_n"), F.lit(True).alias("_in_new"))
    both = o.join(n, key, "full_outer")
    change = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(~F.col("_o").eqNullSafe(F.col("_n")), "changed")
    return both.select(*key, change.alias("change")).where("change is not null")


def carried_forward(at_cutoff: DataFrame, observed: DataFrame, previous: DataFrame, key: list[str]) -> DataFrame:
    """The rows at the cutoff, and for keys seen only later the row that the last view held."""
    late = observed.join(at_cutoff, key, "left_anti").select(*key).distinct()
    return at_cutoff.withColumn("carried", F.lit(False)).unionByName(previous.join(late, key, "left_semi").withColumn("carried", F.lit(True)))


def formal_winner(df: DataFrame, key: list[str], published: str, updated: str, captured: str, content: str, kind: list[str]) -> DataFrame:
    """Each key's newest version by published, updated (null last), captured, then the smallest content hash; mixed_kind where parser or mapping differ.

    Rows that agree in all of that are one version. Sums combine before the shuffle; no version list is gathered.
    """
    # For a hash the smallest wins: its digits are turned over so that the largest struct has it.
    turned = F.translate(F.col(content), "0123456789abcdef", "fedcba9876543210")
    order = F.struct(F.col(published), F.col(updated).isNotNull(), F.col(updated), F.col(captured), turned)
    spread = [F.min(F.struct(*kind)).alias("_lo"), F.max(F.struct(*kind)).alias("_hi")]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*(F.col(x) for x in df.columns if x not in key)), order).alias("_b"), *spread)
    return best.select(*key, "_b.*", F.when(F.col("_lo") == F.col("_hi"), "chosen").otherwise("mixed_kind").alias("state"))
