"""Models whose CDS lies between their exons: they code for nothing, and no rule about UTRs stumbles over them."""

import duckdb
import pytest

from genefeat.operators import models
from genefeat.plans import oracles, queries

from .test_models import exons, mirrored, tx


def write(spark, path, lines):
    """lines: (order, line number, quantity)."""
    spark.createDataFrame([(o, n, 5, float(q)) for o, n, q in lines], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double").coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(o, 1) for o in {x[0] for x in lines}], "o_orderkey bigint, o_custkey bigint").coalesce(1).write.parquet(f"{path}/orders.parquet")


def told(name, path):
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    return sorted(con.execute(oracles.ORACLES[name]).fetchall(), key=str)


@pytest.mark.parametrize("name", ["augment_sets", "sub_chain_filter", "collapse_transcripts", "translation_coords"])
def test_a_cds_without_exons_is_none(spark, tmp_path, name):
    d = str(tmp_path)
    # 1000006 (busco) has the place of 6 (transcriptomic), and two exons so short that its CDS lies between them.
    write(spark, d, [(6, 2, 50), (6, 3, 50), (6, 4, 50), (1_000_006, 1, 1), (1_000_006, 7, 1), (1_000_018, 1, 30), (1_000_018, 2, 30), (1_000_018, 3, 30)])
    df = queries.QUERIES[name](spark, d)
    want = told(name, d)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want
    assert all(r[0] != 1_000_006 for r in want)


@pytest.mark.parametrize("strand", "+-")
def test_trims_drop_models_without_exons(spark, strand):
    turn = (lambda x: x) if strand == "+" else mirrored
    rows = [(n, strand, turn(x), turn([c])[0]) for n, x, c in (("past", [(500, 600)], (100, 200)), ("before", [(1, 50)], (100, 200)), ("codes", [(1, 400)], (100, 200)))]
    assert {k: turn(v) for k, v in exons(models.trim_three_prime(tx(spark, *rows))).items()} == {"before": [(1, 50)], "codes": [(1, 400)]}
    assert {k: turn(v) for k, v in exons(models.trim_five_prime(tx(spark, *rows))).items()} == {"past": [(500, 600)], "codes": [(1, 400)]}
