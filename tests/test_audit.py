import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakeops.operators import audit

COLUMNS = ["id", "text", "n"]


def table(spark, ids):
    return spark.createDataFrame([(i, None if i % 7 == 0 else f"row {i}", i / 2) for i in ids], "id bigint, text string, n double")


def rows(tree):
    return sorted(map(tuple, tree.select("level", "block", "rows", "digest").collect()))


@pytest.mark.parametrize("older, newer, block", [
    (range(1, 40), range(40, 95), 4), (range(1, 4), range(4, 6), 4), (range(0, 1), range(500, 520), 3), (range(10, 30), range(4000, 4040, 3), 5), (range(5, 9), [], 4)])
def test_an_appended_tree_is_that_of_all_rows(spark, older, newer, block):
    whole = rows(audit.digest_tree(table(spark, [*older, *newer]), "id", COLUMNS, block))
    first = table(spark, older)
    got = audit.append_tree(audit.digest_tree(first, "id", COLUMNS, block), first, table(spark, newer), "id", COLUMNS, block)
    assert rows(got) == whole


def test_only_the_edge_is_read(spark):
    first = table(spark, range(100)).withColumn("text", F.when(F.col("id") < 90, F.raise_error(F.lit("read")).cast("string")).otherwise(F.col("text")))
    tree = audit.digest_tree(table(spark, range(100)), "id", COLUMNS, 10)
    got = audit.append_tree(tree, first, table(spark, range(100, 103)), "id", COLUMNS, 10)
    assert rows(got) == rows(audit.digest_tree(table(spark, range(103)), "id", COLUMNS, 10))
    with pytest.raises(ValueError):
        audit.append_tree(tree, table(spark, range(100)), table(spark, [50]), "id", COLUMNS, 10)


def test_proofs_hold_and_tampered_ones_do_not(spark):
    rng = random.Random(3)
    ids = sorted(rng.sample(range(2000), 120))
    rows_ = table(spark, ids)
    tree = audit.digest_tree(rows_, "id", COLUMNS, 6)
    root = tree.orderBy(F.desc("level")).first()["digest"]
    texts = {r.id: r.t for r in rows_.select("id", audit.row_text(COLUMNS).alias("t")).collect()}
    for i in rng.sample(ids, 5):
        proof = audit.prove(tree, rows_, i, "id", COLUMNS, 6)
        assert len(proof.steps) == tree.agg(F.max("level")).first()[0]
        assert audit.verify_proof(texts[i], proof, root)
        assert not audit.verify_proof(texts[i].replace("row", "raw") + " ", proof, root)
        place, others = proof.steps[0]
        for changed in ((place + 1, others), (len(others) + 1, others), (-1, others), (place, ("0" * 64, *others[1:]) if others else ("0" * 64,))):
            assert not audit.verify_proof(texts[i], replace(proof, steps=(changed, *proof.steps[1:])), root)
        assert not audit.verify_proof(texts[i], replace(proof, steps=proof.steps[:-1]), root)
        assert not audit.verify_proof(texts[i], proof, "0" * 64)
    assert audit.prove(tree, rows_, next(i for i in range(2000) if i not in ids), "id", COLUMNS, 6) is None
