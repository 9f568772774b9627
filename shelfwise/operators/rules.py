"""Declared constraints of a model, and their audit in one scan per table and one shuffle.

Each table's rows become facts about keys: a key of its own, a reference to another table's key, or a broken rule of the
row itself. Facts of all tables are one table, grouped by key kind and key: where the owner is missing all references
are orphans, where it occurs twice the key is repeated. Facts are counted in the map tasks, so a game that a third of
all rows refer to reaches its group as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Constraints of one table. Names of rules are ``table.column ...``."""

    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # column, other table, its key
    checks: tuple[tuple[str, Callable[[], Column]], ...] = ()


def rating_in_range() -> Column:
    return F.col("rating").between(0, 100)


# Rules of the model's tables; a null passes checks, references and uniqueness, as in SQL.
MODEL_RULES = {
    "games": Rules(("id", "game_title"), (("id",),)),
    "genres": Rules(("id", "genre_name"), (("id",), ("genre_name",))),
    "game_genres": Rules(("id",), (("id",), ("game_id", "genre_id")), (("game_id", "games", "id"), ("genre_id", "genres", "id"))),
    "media_files": Rules(("id",), (("id",),), (("game_id", "games", "id"),)),
    "user_reviews": Rules(("id", "user_name"), (("id",),), (("game_id", "games", "id"),), (("rating in range", rating_in_range),)),
}
# Columns that a load or an append fills with its own time.
STAMPED = {"games": ("created_at",), "media_files": ("uploaded_at",), "user_reviews": ("review_date",)}


def unique_name(table: str, columns: tuple[str, ...]) -> str:
    return f"{table}.{columns[0]} unique" if len(columns) == 1 else f"{table} pair unique"


def rule_names(rules: dict[str, Rules]) -> Iterator[str]:
    for table, own in rules.items():
        yield from (f"{table}.{c} not null" for c in own.required)
        yield from (unique_name(table, columns) for columns in own.unique)
        yield from (f"{table}.{column} references {parent}" for column, parent, _ in own.references)
        yield from (f"{table}.{name}" for name, _ in own.checks)


def key_text(columns: tuple[str, ...]) -> Column:
    """A key as text: null if a part is; parts of a compound key are told apart by their lengths."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])


def facts(name: str, table: DataFrame, rules: dict[str, Rules], slots: dict[str, list[str]]) -> DataFrame:
    """(kind, key, slot) of one table, from one scan. Slot 0 owns a key, others refer to it by the rule of that place.

    A row that breaks a rule of its own is a reference to a key that nobody owns. ``slots`` collects the rules of each kind.
    """
    own, found = rules[name], []

    def fact(kind: str, key: Column, rule: str, when: Column, owns: bool = False) -> None:
        names = slots.setdefault(kind, [""])
        if owns:
            names[0] = rule
        else:
            names.append(rule)
        slot = F.lit(0 if owns else len(names) - 1)
        found.append(F.when(when, F.struct(F.lit(kind).alias("kind"), key.alias("key"), slot.alias("slot"))))

    targets = {(key,) for r in rules.values() for _, parent, key in r.references if parent == name}
    for columns in dict.fromkeys([*own.unique, *sorted(targets)]):
        key = key_text(columns)
        fact(f"{name}.{'+'.join(columns)}", key, unique_name(name, columns) if columns in own.unique else "", key.isNotNull(), True)
    for column, parent, parent_key in own.references:
        key = key_text((column,))
        fact(f"{parent}.{parent_key}", key, f"{name}.{column} references {parent}", key.isNotNull())
    broken = {f"{name}.{column} not null": F.col(column).isNull() for column in own.required}
    broken |= {f"{name}.{rule}": F.coalesce(~condition(), F.lit(False)) for rule, condition in own.checks}
    for rule, when in broken.items():
        fact(rule, F.lit(""), rule, when)
    return table.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def audit(tables: dict[str, DataFrame], rules: dict[str, Rules] = MODEL_RULES) -> DataFrame:
    """One row per rule of the given tables with its violations: repeated keys, orphans, or rows that break it.

    References to tables that aren't given are left out. An empty table breaks nothing.
    """
    held = {}
    for name in tables:
        own = rules[name]
        held[name] = Rules(own.required, own.unique, tuple(r for r in own.references if r[1] in tables), own.checks)
    slots: dict[str, list[str]] = {}
    everything = reduce(DataFrame.unionByName, [facts(name, table, held, slots) for name, table in tables.items()])
    most = max(map(len, slots.values()))
    counts = [F.count(F.when(F.col("slot") == i, 1)).alias(f"n{i}") for i in range(most)]
    keys = everything.groupBy("kind", "key").agg(*counts)
    rule_of = F.create_map(*[F.lit(x) for kind, names in slots.items() for i, rule in enumerate(names) for x in (f"{kind} {i}", rule)])
    broken = [F.when(F.col("n0") > 1, 1).otherwise(0), *(F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(0) for i in range(1, most))]
    entries = [
        F.struct(rule_of[F.concat("kind", F.lit(f" {i}"))].alias("rule"), n.cast("bigint").alias("violations")) for i, n in enumerate(broken)
    ]
    sums = (
        keys.select(F.inline(F.filter(F.array(*entries), lambda x: x["violations"] > 0)))
        .groupBy("rule").agg(F.sum("violations").alias("violations"))
    )
    names = everything.sparkSession.createDataFrame([(r,) for r in rule_names(held)], "rule string")
    return names.join(sums, "rule", "left").select("rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))
