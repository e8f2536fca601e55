import __spark_entry__ as E
from stratum.plans.oracle import ORACLE_SQL
from stratum.plans.queries import REGISTRY

from .conftest import SF_SMOKE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "period", "n_entries", "n_films"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE_SQL) and len(REGISTRY) >= 60
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
