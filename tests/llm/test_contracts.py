"""The queries of this package: one for each operator, and which have SQL."""

import re

import __spark_entry__ as entry
from curata.llm import contracts


def test_every_operator_has_its_query():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in contracts.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(contracts.QUERIES) < set(entry.queries()) and set(contracts.SQL) <= set(contracts.QUERIES)
    assert entry.queries()["pipeline"]
