"""SQL functions say what the expressions say."""

import pytest

from sluice.functions import masks, sql, text, values

INPUTS = [None, "", "  ", "NULL", " n/a ", "x", " John ", "john.doe@gmail.com", "@no.com", "***@no.com", "a@b@c", "555-123-4567", "12", "1985-03-15", "1985-**-**", "52000", "-1", "24999.99", "0-24999", "unknown", "text", "1e400", "inf", "IL 62701-1234", "é1"]


@pytest.fixture(scope="module")
def frame(spark, policy):
    sql.register(spark, policy)
    return spark.createDataFrame(list(enumerate(INPUTS)), "i int, x string")


@pytest.mark.parametrize("name", ["strip_space", "is_missing", "value_shape", "redact", "postal_code", "mask_initial", "mask_email_local", "mask_last_four", "mask_year_only", "mask_suppress", "mask_band"])
def test_same(frame, policy, name):
    plain = {"strip_space": text.strip, "is_missing": text.is_missing, "value_shape": text.shape, "redact": text.redact, "postal_code": values.postal_code}
    f = plain[name] if name in plain else masks.strategy(policy, name[5:])
    rows = frame.orderBy("i").select(f("x").alias("a")).collect()
    assert [r[0] for r in frame.orderBy("i").selectExpr(f"sluice_{name}(x)").collect()] == [r[0] for r in rows]
