"""Data changes as jobs: read, transform, and hand back the new version of the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from loomframe.operators.joins import salted_join
from loomframe.operators.ordering import number_rows
from loomframe.session import stage


def append_rows(df: DataFrame, rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Append rows; those without a key column get the next keys in the given order."""
    if key not in rows.columns:
        last = df.select(F.coalesce(F.max(key), F.lit(0))).scalar()
        rows = number_rows(rows, order_by, name="__no")
        new_key = (last + F.col("__no")).cast(df.schema[key].dataType)
        rows = rows.withColumn(key, new_key).drop("__no")
    return df.unionByName(rows)


def update_where(df: DataFrame, condition: Column, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def delete_one(df: DataFrame, condition: Column, key: Sequence[str]) -> DataFrame:
    """Delete the first matching row; ``key`` identifies a row and gives the order."""
    victim = df.where(condition).select(*key).orderBy(*key).limit(1)
    renamed = victim.select(*[F.col(c).alias(f"__{c}") for c in key])
    same = [df[c].eqNullSafe(F.col(f"__{c}")) for c in key]
    # one row
    return df.join(F.broadcast(renamed), same, "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def refresh_rollup(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    amount: Column,
    name: str,
    changed: DataFrame | None = None,
) -> DataFrame:
    """Total of the child amounts per parent, 0 without children.

    With ``changed`` (a DataFrame of one key column) only those parents are recomputed, from
    the children of those keys alone; the others keep the total in column ``name``. Deletions
    are covered as well, since totals are always computed from the children that are there.
    """
    if changed is not None:
        changed = changed.select(F.col(changed.columns[0]).alias("__changed")).distinct()
    totals = child.groupBy(F.col(child_key).alias("__key")).agg(F.sum(amount).alias("__total"))
    if changed is not None:
        # Catalyst moves this below the aggregation when the batch is small enough to broadcast
        totals = totals.join(changed, F.col("__key") == F.col("__changed"), "left_semi")
    joined = parent.join(totals, parent[parent_key] == F.col("__key"), "left")
    fresh = F.coalesce("__total", F.lit(0))
    if changed is not None:
        joined = joined.join(changed, parent[parent_key] == F.col("__changed"), "left")
        fresh = F.when(F.col("__changed").isNotNull(), fresh).otherwise(F.col(name))
    return joined.withColumn(name, fresh).select(
        *parent.columns, *([] if name in parent.columns else [name])
    )


class Admission(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def taken_places(admitted: DataFrame, key: str) -> DataFrame:
    return admitted.groupBy(key).agg(F.count("*").alias("taken"))


def judge_arrivals(
    incoming: DataFrame,
    capacity: DataFrame,
    key: str,
    limit: str,
    order_by: Sequence[str],
    taken: DataFrame | None = None,
) -> DataFrame:
    """Arrivals with their ``arrival_no`` per key, and ``accepted`` 1 while there is room.

    ``capacity`` holds ``key`` and ``limit``; a NULL limit, or no row for the key, always
    admits. ``taken`` (from :func:`taken_places`) counts the places that are gone already.
    Arrivals are numbered over range partitions, so one key may hold any share of them.
    """
    room = capacity.select(key, F.col(limit).cast("bigint").alias("__limit"))
    if taken is not None:
        left = F.col("__limit") - F.coalesce("taken", F.lit(0))
        room = room.join(taken, key, "left").select(key, left.alias("__limit"))
    numbered = number_rows(incoming, order_by, within=[key], name="arrival_no")
    sizes = numbered.groupBy(key).agg(F.max("arrival_no").alias("__size"))
    judged = salted_join(
        numbered, room.join(sizes, key), [key], "__size", F.col("arrival_no"), "left"
    )
    fits = F.col("__limit").isNull() | (F.col("arrival_no") <= F.col("__limit"))
    return judged.withColumn("accepted", fits.cast("int")).select(
        *incoming.columns, "arrival_no", "accepted"
    )


def admit_until_full(
    incoming: DataFrame,
    capacity: DataFrame,
    key: str,
    limit: str,
    order_by: Sequence[str],
    taken: DataFrame | None = None,
) -> Admission:
    """Accepted and rejected arrivals, as judged by :func:`judge_arrivals`."""
    judged = judge_arrivals(incoming, capacity, key, limit, order_by, taken)
    accepted, rejected = (judged.where(F.col("accepted") == i).drop("accepted") for i in (1, 0))
    return Admission(accepted, rejected)


class ForeignKey(NamedTuple):
    """``child_key`` refers to ``parent_key``; both are a column or several in the same order."""

    child: str
    child_key: str | Sequence[str]
    parent: str
    parent_key: str | Sequence[str]
    on_delete: str = "cascade"  # or "set null"


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _top_down(links: Sequence[ForeignKey], root: str) -> list[str]:
    """Tables that can be reached from the root, each after all its parents among them."""
    reached = {root}
    while more := {k.child for k in links if k.parent in reached} - reached:
        reached |= more
    parents = {t: {k.parent for k in links if k.child == t and k.parent in reached} for t in reached}
    order: list[str] = []
    while len(order) < len(reached):
        ready = sorted(t for t in reached - set(order) if t == root or parents[t] <= set(order))
        if not ready or root in {k.child for k in links if k.parent in reached}:
            raise ValueError("the foreign keys form a circle")
        order += ready
    return order


def _marked(df: DataFrame, columns: Sequence[str], keys: DataFrame, mark: str) -> DataFrame:
    """``df`` with a column that says whether its columns hold one of the keys; NULL never does."""
    named = [f"__k{i}" for i in range(len(columns))]
    distinct = keys.toDF(*named).distinct().withColumn(mark, F.lit(True))
    same = [df[c] == distinct[n] for c, n in zip(columns, named)]
    return df.join(distinct, same, "left").drop(*named).withColumn(mark, F.coalesce(mark, F.lit(False)))


def _closure(df: DataFrame, links: Sequence[ForeignKey], gone: DataFrame, names: list[str]) -> DataFrame:
    """Keys of ``df`` that go because its own links, from child to parent row, lead to one in ``gone``.

    Each round follows the keys of the round before only, and ends when it finds no new one; so a
    circle of rows ends, too. A round is two joins on keys, stored; ``gone`` is part of the result.
    """
    found = stage(gone.select(*names).dropna().distinct(), "gone")
    frontier = found
    columns = list(dict.fromkeys([*names, *(c for link in links for c in _names(link.child_key))]))
    keys = stage(df.select(*columns), "own-keys")
    while not frontier.isEmpty():
        reached = []
        for link in links:
            above = frontier.toDF(*[f"__p{i}" for i in range(len(names))])
            same = [keys[c] == above[f"__p{i}"] for i, c in enumerate(_names(link.child_key))]
            reached.append(keys.join(above, same, "left_semi").select(*names))
        new = reduce(DataFrame.unionByName, reached).dropna().distinct()
        frontier = stage(new.join(found, names, "left_anti"), "frontier")
        found = stage(found.unionByName(frontier), "gone")
    return found


def cascade_delete(
    tables: dict[str, DataFrame],
    links: Sequence[ForeignKey],
    root: str,
    doomed: DataFrame,
    key: str | Sequence[str],
) -> dict[str, DataFrame]:
    """Delete rows of ``root`` by key and follow the foreign keys, parents before children.

    ``doomed`` holds the keys to delete. A child goes when any of its cascading links points to a
    deleted row, on whatever path; otherwise its other links to deleted rows become NULL. Links
    may be listed in any order. A table may refer to itself, by its own parent key: then deletions
    run down its rows to the end of every branch. Several tables must not form a circle.
    """
    out, removed = dict(tables), {}
    own = {t: [k for k in links if k.child == k.parent == t] for t in tables}
    links = [k for k in links if k.child != k.parent]
    for table in _top_down(links, root):
        df, columns = tables[table], tables[table].columns
        if table == root:
            df, goes = _marked(df, _names(key), doomed, "__goes"), F.col("__goes")
        else:
            goes = F.lit(False)
            incoming = [k for k in links if k.child == table and k.parent in removed]
            for i, link in enumerate(incoming):
                keys = removed[link.parent].select(*_names(link.parent_key))
                df = _marked(df, _names(link.child_key), keys, f"__m{i}")
                if link.on_delete == "cascade":
                    goes = goes | F.col(f"__m{i}")
        down = [k for k in own.get(table, []) if k.on_delete == "cascade"]
        if down:
            names = _names(down[0].parent_key)
            if any(_names(k.parent_key) != names for k in down):
                raise ValueError(f"{table} refers to itself by different keys")
            doomed_keys = _closure(tables[table], down, df.where(goes).select(*names), names)
            # a row goes with its parent row, whether it has a key of its own or not
            for i, link in enumerate(down):
                df = _marked(df, _names(link.child_key), doomed_keys, f"__b{i}")
                goes = goes | F.col(f"__b{i}")
        removed[table] = df.where(goes).select(columns)
        left = df.where(~goes)
        for i, link in enumerate(k for k in own.get(table, []) if k.on_delete != "cascade"):
            left = _marked(left, _names(link.child_key), removed[table].select(*_names(link.parent_key)), f"__s{i}")
            left = left.withColumns({c: F.when(~F.col(f"__s{i}"), F.col(c)) for c in _names(link.child_key)})
        if table != root:
            for i, link in enumerate(incoming):
                if link.on_delete != "cascade":
                    left = left.withColumns(
                        {c: F.when(~F.col(f"__m{i}"), F.col(c)) for c in _names(link.child_key)}
                    )
        out[table] = left.select(columns)
    return out


def cascade_update(
    tables: dict[str, DataFrame],
    links: Sequence[ForeignKey],
    root: str,
    changed: DataFrame,
    key: str | Sequence[str],
) -> dict[str, DataFrame]:
    """Give rows of ``root`` new keys and carry them into all tables that refer to them.

    ``changed`` holds, one row per old key, the old key's columns and then the new key's in the
    same order. A child's own key that contains the changed columns is carried on in turn.
    """
    out, before = dict(tables), {}

    def replaced(df: DataFrame, columns: list[str], pairs: DataFrame) -> DataFrame:
        old, new = ([f"__{kind}{i}" for i in range(len(columns))] for kind in "on")
        named = pairs.toDF(*old, *new).withColumn("__hit", F.lit(True))
        joined = df.join(named, [df[c] == named[o] for c, o in zip(columns, old)], "left")
        fresh = {c: F.when(F.col("__hit"), F.col(n)).otherwise(F.col(c)) for c, n in zip(columns, new)}
        return joined.withColumns(fresh).select(df.columns)

    for table in _top_down(links, root):
        columns = tables[table].columns
        # the old values stay next to the new ones, for the tables further down
        df = tables[table].withColumns({f"__was_{c}": F.col(c) for c in columns})
        if table == root:
            df = replaced(df, _names(key), changed)
        for link in links:
            if link.child != table or link.parent not in before:
                continue
            names = _names(link.parent_key)
            was = [F.col(f"__was_{c}") for c in names]
            moved = before[link.parent].select(*was, *names)
            differs = reduce(or_, [~w.eqNullSafe(F.col(c)) for w, c in zip(was, names)])
            df = replaced(df, _names(link.child_key), moved.where(differs).distinct())
        before[table] = df
        out[table] = df.select(columns)
    return out
