from collections import Counter
from types import SimpleNamespace

from martkit.catalog import storage


def test_append_log_takes_every_status(spark):
    rows = [(s, "1-URGENT") for s in ("P", "F", "O", "X", None, "O")]
    orders = spark.createDataFrame(rows, "o_orderstatus string, o_orderpriority string")
    got = {r.o_orderstatus: r.n for r in storage.append_log(SimpleNamespace(spark=spark, orders=orders)).collect()}
    assert got == Counter(s for s, _ in rows)
