"""Boolean search strings from concepts and templates: plain strings on the driver, and Columns for tables of terms."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(items: Iterable[str]) -> list[str]:
    """Non-empty items in order of first appearance."""
    return [x for x in dict.fromkeys(items) if x]


def concept(terms: Iterable[str]) -> str:
    """Quoted terms, joined by OR in brackets if there are several."""
    quoted = [f'"{t}"' for t in (x.strip().strip('"') for x in terms) if t]
    return quoted[0] if len(quoted) == 1 else f"({' OR '.join(quoted)})" if quoted else ""


def render(template: str, population: str, intervention: str) -> str:
    """Fill {P} and {I}, or else {terms} with both; quotes right around a placeholder go."""
    values = {"P": population, "I": intervention}
    if not any("{%s}" % k in template for k in values):
        values = {"terms": f"{population} AND {intervention}"}
    template = _bare(template, values)
    for k, v in values.items():
        template = template.replace("{%s}" % k, v)
    return template


def concept_column(terms: Column) -> Column:
    """``concept`` of an array of terms."""
    bare = F.transform(F.filter(terms, lambda t: t != ""), lambda t: F.regexp_replace(F.trim(t), '^"+|"+$', ""))
    quoted = F.transform(bare, lambda t: F.concat(F.lit('"'), t, F.lit('"')))
    several = F.concat(F.lit("("), F.array_join(quoted, " OR "), F.lit(")"))
    return F.when(F.size(quoted) > 1, several).otherwise(F.array_join(quoted, ""))


def render_columns(template: str, population: Column, intervention: Column) -> Column:
    """``render`` of two concepts: the parts of the template around its placeholders, and the concepts between them."""
    holes = {"P": population, "I": intervention}
    if not any("{%s}" % k in template for k in holes):
        holes = {"terms": F.concat(population, F.lit(" AND "), intervention)}
    parts = re.split("\\{(%s)\\}" % "|".join(holes), _bare(template, holes))
    return F.concat(*[holes[x] if k % 2 else F.lit(x) for k, x in enumerate(parts)])


def _bare(template: str, holes: Iterable[str]) -> str:
    """The template without quotes right around its placeholders."""
    for k in holes:
        hole = "{%s}" % k
        template = template.replace(f'\\"{hole}\\"', hole).replace(f'"{hole}"', hole)
    return template


def compiled(population: Iterable[str], intervention: Iterable[str], templates: dict[str, list[str]]) -> dict[str, list[str]]:
    p, i = concept(population), concept(intervention)
    return {source: once(render(t, p, i) for t in own) for source, own in templates.items()}


def rendered(terms: Iterable[str], templates: Iterable[str]) -> list[str]:
    """Every term in every template."""
    templates = list(templates)
    return once(t.replace("{terms}", x) for x in terms for t in templates)


def expanded(terms: list[str], variants: Callable[[list[str]], Iterable[str]] | None) -> list[str]:
    """Terms and their variants by an injected function; the terms alone if it fails."""
    if variants is None:
        return once(terms)
    try:
        return once([*terms, *variants(terms)])
    except Exception:  # noqa: BLE001  expansion is optional
        return once(terms)
