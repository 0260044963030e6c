"""Matching rules: is a response right, given the expected answer and the task?

A rule takes a :class:`Reply` of columns and gives a boolean column. ``RULES``
maps task names to rules; add an entry to support another task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollwright.functions.answers import numbers
from pollwright.functions.text import strip


@dataclass(frozen=True)
class Reply:
    """Columns a rule may look at.

    ``raw`` is the answer, ``clean`` its normal form and ``found`` the
    identifiers in it, computed for ``SET_TASKS`` only; ``expected`` is the
    expected text, ``wanted`` its normal form in lower case, computed for other
    tasks only, ``items`` what it lists, ``is_list`` whether it is a list.
    """

    raw: Column
    clean: Column
    found: Column
    expected: Column
    wanted: Column
    items: Column
    is_list: Column


def same_identifiers(reply: Reply) -> Column:
    """The identifiers named are exactly the expected list, or hold its one value."""
    items = F.transform(reply.items, strip)
    first = F.get(items, F.lit(0))
    both_none = (F.lower(reply.clean) == "none") & ~reply.is_list & (F.lower(first) == "none")
    equal = F.sort_array(reply.found) == F.sort_array(F.array_distinct(items))
    holds = F.array_contains(reply.found, first)
    return F.when(both_none, True).when(reply.is_list, equal).otherwise(holds)


def contains_text(reply: Reply) -> Column:
    """The expected text occurs in the response, whatever the case."""
    return F.lower(reply.clean).contains(reply.wanted)


def names_number(reply: Reply) -> Column:
    """The first number expected is among the numbers of the response."""
    wanted = F.get(numbers(reply.expected), F.lit(0))
    return F.coalesce(F.array_contains(numbers(reply.raw), wanted), F.lit(False))


Rule = Callable[[Reply], Column]

RULES: dict[str, Rule] = {
    "rule_based_querying": same_identifiers,
    "answer_reverse_lookup": same_identifiers,
    "multi_hop_relational_inference": same_identifiers,
    "conceptual_aggregation": names_number,
    "respondent_count": names_number,
    "answer_lookup": contains_text,
}
DEFAULT_RULE: Rule = contains_text
SET_TASKS = [task for task, rule in RULES.items() if rule is same_identifiers]


def rule_name(task: Column) -> Column:
    return F.lower(strip(F.coalesce(task, F.lit(""))))


def dispatch(name: Column, reply: Reply) -> Column:
    """The verdict of the rule called ``name``; each rule is expanded once."""
    by_rule: dict[Rule, list[str]] = {}
    for key, rule in RULES.items():
        by_rule.setdefault(rule, []).append(key)
    by_rule.pop(DEFAULT_RULE, None)
    branches = [(name.isin(keys), rule(reply)) for rule, keys in by_rule.items()]
    chain = reduce(lambda done, b: done.when(b[0], b[1]), branches[1:], F.when(*branches[0]))
    return chain.otherwise(DEFAULT_RULE(reply))
