"""Header naming on ``array<string>`` columns (one header per sheet, computed in the layout).

All rules are higher-order functions over the header array, so any number of differently shaped
sheets share one plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheetfold.functions.text import strip_py, upper


def _first_free(acc: Column, base: Column, sep: str) -> Column:
    """Smallest k >= 1 with ``base || sep || k`` not in ``acc`` (k <= size(acc)+1 always exists)."""
    ks = F.sequence(F.lit(1), F.size(acc) + F.lit(1))
    free = F.filter(ks, lambda k: ~F.array_contains(acc, F.concat(base, F.lit(sep), k.cast("string"))))
    return F.concat(base, F.lit(sep), F.try_element_at(free, F.lit(1)).cast("string"))


def pad_header(header: Column, width: Column) -> Column:
    """Pad the header with '' up to ``width`` cells."""
    missing = F.greatest(width - F.size(header), F.lit(0))
    return F.concat(header, F.array_repeat(F.lit(""), missing))


def dedupe_checked(header: Column, blank_prefix: str = "column_") -> Column:
    """Strip each name; blank → ``column_{i}``; a taken name gets the first free ``_1``, ``_2``…

    ``X, X_1, X, '', X`` → ``X, X_1, X_2, column_3, X_3``.
    """
    bases = F.transform(header, lambda h, i: F.when(F.coalesce(strip_py(h), F.lit("")) != "", strip_py(h))
                        .otherwise(F.concat(F.lit(blank_prefix), i.cast("string"))))

    def step(acc, b):
        return F.array_append(acc, F.when(~F.array_contains(acc, b), b).otherwise(_first_free(acc, b, "_")))

    return F.aggregate(bases, F.array().cast("array<string>"), step)


def dedupe_counter(header: Column, blank_name: str = "Unnamed") -> Column:
    """Strip each name; blank → ``Unnamed``; the n-th repeat of a base becomes ``base_n`` without
    checking that the result is free (``X, X_1, X`` → ``X, X_1, X_1``: see :func:`has_duplicates`)."""
    bases = F.transform(header, lambda h: F.when(F.coalesce(strip_py(h), F.lit("")) != "", strip_py(h))
                        .otherwise(F.lit(blank_name)))
    return F.transform(bases, lambda b, i: F.when(
        F.size(F.filter(bases, lambda x, j: (j < i) & (x == b))) == 0, b
    ).otherwise(F.concat(b, F.lit("_"), F.size(F.filter(bases, lambda x, j: (j < i) & (x == b))).cast("string"))))


def has_duplicates(names: Column) -> Column:
    return F.size(F.array_distinct(names)) < F.size(names)


def canonical_names(names: Column, dictionary: Column, rules: list[tuple[Column, str]]) -> Column:
    """Map names left to right: exact dictionary hit, else the first matching rule, else itself.

    A target already taken falls back to the column's own name, then ``{name}_dup{n}``.
    ``rules`` is a list of (predicate on the name, target).
    """
    def target(c):
        expr = None
        for pred, tgt in rules:
            expr = F.when(pred(c), F.lit(tgt)) if expr is None else expr.when(pred(c), F.lit(tgt))
        ruled = expr.otherwise(c) if expr is not None else c
        return F.coalesce(F.try_element_at(dictionary, c), ruled)

    pairs = F.transform(names, lambda c: F.struct(c.alias("n"), target(c).alias("t")))

    def step(acc, p):
        n, t = p["n"], p["t"]
        name = (F.when(~F.array_contains(acc, t), t)
                .when(~F.array_contains(acc, n), n)
                .otherwise(_first_free(acc, n, "_dup")))
        return F.array_append(acc, name)

    return F.aggregate(pairs, F.array().cast("array<string>"), step)


def first_matching(names: Column, keywords: list[str]) -> Column:
    """First name whose upper case contains any keyword (null when none)."""
    def pred(n):
        u = upper(n)
        cond = None
        for kw in keywords:
            cond = u.contains(kw) if cond is None else (cond | u.contains(kw))
        return cond

    return F.try_element_at(F.filter(names, pred), F.lit(1))


def first_name_with(names: list[str], keyword: str) -> str | None:
    """:func:`first_matching` for the column names of a table."""
    found = [n for n in names if keyword in n.upper()]
    return found[0] if found else None


def counted_names(header: list[str]) -> list[str]:
    """:func:`dedupe_counter` for one header row: stripped, blanks ``Unnamed``, repeats ``_1``, ``_2``, …"""
    seen: dict[str, int] = {}
    out = []
    for cell in header:
        name = cell.strip() or "Unnamed"
        out.append(name if name not in seen else f"{name}_{seen[name]}")
        seen[name] = seen.get(name, 0) + 1
    return out


def position_of(names: Column, name: Column) -> Column:
    """0-based position of ``name`` in ``names``; null when absent."""
    p = F.array_position(names, name)
    return F.when(p > 0, (p - 1).cast("int"))
