"""Following documents to their sources, and what is left of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.joins import all_present

#: Columns of ``with_taken``: sum of the children's quantities, number of children, of those with a quantity.
TAKEN = ("__taken", "__children", "__valued")


def with_taken(parent: DataFrame, child: DataFrame, link: Mapping[str, str], child_qty: str) -> DataFrame:
    """Every parent row with ``TAKEN``, what its children took in all; NULLs without children."""
    totals = child.groupBy(*link.values()).agg(
        F.sum(child_qty).alias("__taken"), F.count(F.lit(1)).alias("__children"), F.count(child_qty).alias("__valued")
    )
    totals = totals.select(*[F.col(c).alias(f"__{c}") for c in link.values()], *TAKEN)
    joined = parent.join(totals, [parent[p] == totals[f"__{c}"] for p, c in link.items()], "left")
    return joined.select(*parent.columns, *TAKEN)


def residual_total(taken: DataFrame, parent_qty: str, keys: Sequence[str], name: str) -> DataFrame:
    """Sum per ``keys`` of the quantities that ``residual_union`` shows for the parents of
    ``with_taken``, found without making its rows."""
    lone, rest = F.col("__children").isNull(), F.col(parent_qty) - F.col("__taken")
    unvalued = F.col("__children") - F.col("__valued")
    parts = {
        "__t": F.col("__taken"), "__alone": F.when(lone, F.col(parent_qty)),
        "__filled": F.when(unvalued > 0, F.col(parent_qty) * unvalued), "__rest": F.when(rest > 0, rest),
    }
    sums = taken.groupBy(*keys).agg(*[F.sum(part).alias(n) for n, part in parts.items()])
    total = sum((F.coalesce(n, F.lit(0)) for n in parts), F.lit(0))
    return sums.select(*keys, F.when(F.coalesce(*parts).isNotNull(), total).alias(name))


def residual_union(
    parent: DataFrame,
    child: DataFrame,
    link: Mapping[str, str],
    parent_qty: str,
    child_qty: str,
    out_qty: str,
    keep_child_qty: bool = False,
    with_rest: bool = True,
    taken_known: bool = False,
) -> DataFrame:
    """Matched rows plus one row for the quantity no child has taken.

    ``link`` maps parent key columns (unique per parent row) to child columns. Every
    parent appears with each child (quantity: the child's, else the parent's), or alone;
    a parent whose children sum to less appears once more with the rest. The pairs come
    from an inner join, which adaptive execution can split when one parent owns a large
    part of the children; the other rows need only one total per parent. Without
    ``with_rest`` only the matched rows and the parents without children are returned.
    ``taken_known`` says that ``parent`` comes from ``with_taken``; it is not joined with
    the totals again, and parents without children are not shuffled.
    """
    own, whole_key = [c for c in parent.columns if c not in TAKEN], all_present(list(link))
    # One filter for both joins, so that one shuffle of the parents serves both.
    keyed = parent.where("__children IS NOT NULL" if taken_known else whole_key)
    extra = [c for c in child.columns if c not in link.values() and (keep_child_qty or c != child_qty)]
    side = child.select(
        *[F.col(c).alias(f"__{c}") for c in link.values()], F.col(child_qty).alias("__qty"), *extra
    )
    pairs = keyed.join(side, [keyed[p] == side[f"__{c}"] for p, c in link.items()]).select(
        *own, *extra, F.coalesce("__qty", parent_qty).alias(out_qty)
    )
    if taken_known:
        alone = parent
    else:
        alone = with_taken(keyed, child, link, child_qty).unionByName(parent.where(~whole_key), allowMissingColumns=True)
    rest, shown = F.col(parent_qty) - F.col("__taken"), F.col("__children").isNull()
    alone = alone.where(shown | (rest > 0) if with_rest else shown).select(
        *own,
        *[F.lit(None).cast(side.schema[c].dataType).alias(c) for c in extra],
        F.when(shown, F.col(parent_qty)).otherwise(rest).alias(out_qty),
    )
    return pairs.unionByName(alone)


def residual_reversed(
    parent: DataFrame, child: DataFrame, link: Mapping[str, str], parent_qty: str, child_qty: str, out_qty: str
) -> DataFrame:
    """Rows for what children received beyond their parent, as one report defines it.

    Per parent and distinct child quantity: child quantity less the parent quantity summed
    over the children with that quantity, where positive.
    """
    side = child.groupBy(*link.values(), child_qty).agg(F.count(F.lit(1)).alias("__children"))
    side = side.select(*[F.col(c).alias(f"__{c}") for c in link.values()], F.col(child_qty).alias("__qty"), "__children")
    joined = parent.join(side, [parent[p] == side[f"__{c}"] for p, c in link.items()])
    over = F.col("__qty") - F.col(parent_qty) * F.col("__children")
    return joined.where(over > 0).select(*parent.columns, over.alias(out_qty))


def trace_source(
    df: DataFrame, source: DataFrame, link: Mapping[str, str], take: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Attach columns of the source document line a link points at."""
    side = source.select(
        *[F.col(c).alias(f"__{c}") for c in link.values()], *[F.col(src).alias(n) for n, src in take.items()]
    )
    joined = df.join(side, [df[a] == side[f"__{b}"] for a, b in link.items()], how)
    return joined.drop(*[f"__{c}" for c in link.values()])


def needs_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose link columns are all present and not blank."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) != "")
    return df.where(cond)
