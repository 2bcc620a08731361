"""Column lineage read out of analysed plans: which input columns each output column comes from."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame


def _items(seq) -> Iterator:
    step = seq.iterator()
    while step.hasNext():
        yield step.next()


def _id(attribute) -> int:
    return attribute.exprId().id()


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _ids(expression) -> set[int]:
    return {_id(a) for a in _items(expression.references())}


def _equalities(condition) -> Iterator[tuple[int, int]]:
    """Pairs of columns that a join condition sets equal."""
    kind = _kind(condition)
    if kind == "And":
        yield from _equalities(condition.left())
        yield from _equalities(condition.right())
    elif kind in ("EqualTo", "EqualNullSafe"):
        sides = condition.left(), condition.right()
        if all(_kind(side) == "AttributeReference" for side in sides):
            yield _id(sides[0]), _id(sides[1])


def column_sources(df: DataFrame, inputs: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """For each column of ``df``, the columns of ``inputs`` (``name.column``) it is made from.

    ``df`` must have been built from these very frames. Every column of a plan has a number that it
    keeps through filters, joins and sorts; a projection or aggregation that makes a new one states
    the numbers it uses. So renamed, computed and aggregated columns lead back to the input columns.
    Columns that a join sets equal, or a union puts into one, share their sources. A column made of constants
    only has none, and what a scalar subquery reads is not followed.
    """
    known: dict[int, str] = {}
    leaves: dict[int, list[str]] = {}
    for name, frame in inputs.items():
        plan = frame._jdf.queryExecution().analyzed()
        columns = list(_items(plan.output()))
        known.update({_id(a): f"{name}.{a.name()}" for a in columns})
        if not plan.children().size():  # a self-join gives the copy of a relation numbers of its own
            leaves[plan.semanticHash()] = [f"{name}.{a.name()}" for a in columns]
    made: dict[int, set[int]] = {}
    equal: dict[int, set[int]] = {}

    def visit(node) -> None:
        children = list(_items(node.children()))
        if not children:
            names = leaves.get(node.semanticHash(), [])
            for attribute, source in zip(_items(node.output()), names):
                known.setdefault(_id(attribute), source)
            return
        below = [[_id(a) for a in _items(child.output())] for child in children]
        kind = _kind(node)
        if kind == "Union":
            for place, attribute in enumerate(_items(node.output())):
                equal.setdefault(_id(attribute), set()).update(ids[place] for ids in below)
        if kind == "Join" and node.condition().isDefined():
            for a, b in _equalities(node.condition().get()):
                equal.setdefault(a, set()).add(b)
                equal.setdefault(b, set()).add(a)
        for expression in _items(node.expressions()):
            if _kind(expression) == "Alias":
                made.setdefault(_id(expression), set()).update(_ids(expression.child()))
        passed = {i for ids in below for i in ids}
        fresh = [_id(a) for a in _items(node.output()) if _id(a) not in passed | made.keys()]
        if fresh:  # a generator, or a function over whole rows
            used = {i for e in _items(node.expressions()) for i in _ids(e)} & passed
            for number in fresh:
                made[number] = used or passed
        for child in children:
            visit(child)

    plan = df._jdf.queryExecution().analyzed()
    visit(plan)

    def sources(start: int) -> set[str]:
        found, open_, seen = set(), [start], set()
        while open_:
            number = open_.pop()
            if number in seen:
                continue
            seen.add(number)
            open_ += equal.get(number, ())
            if number in known:
                found.add(known[number])
            else:
                open_ += made.get(number, ())
        return found

    return {a.name(): sorted(sources(_id(a))) for a in _items(plan.output())}
