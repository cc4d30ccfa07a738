"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import difference

from riskframe.plans.oracles import ORACLES
from riskframe.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, DATA), ORACLES[name], DATA) is None


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
