import duckdb
import pytest

from tests import cases_claims, cases_labels
from tests.duck import rows


CASES = cases_claims.CASES | cases_labels.CASES


@pytest.mark.parametrize("name", sorted(CASES))
def test_stated_outcomes(spark, name):
    made, sql = CASES[name]
    df = made(spark, "")
    got = rows([tuple(r) for r in df.collect()], df.columns)
    result = duckdb.connect().execute(sql)
    columns = [x[0] for x in result.description]
    assert sorted(columns) == sorted(df.columns) and got == rows(result.fetchall(), columns)
