"""What the operators reach on the given tables: held-out accuracy, balance and recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsekit.llm import toxicity
from pulsekit.llm.queries import QUERIES, held_out

SF01, SF001 = "/root/testdata/sf0.1", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return QUERIES["op8_toxicity"](spark, SF01).join(labels, "doc_id").filter("held_out AND toxic IS NOT NULL").toPandas()


def test_toxic_documents_are_caught_and_clean_ones_left(scored):
    toxic, flagged = scored.toxic == 1, scored.predicted == 1
    assert toxic.sum() > 50 and (~toxic).sum() > 500
    assert flagged[toxic].mean() >= 0.85 and flagged[~toxic].mean() <= 0.02
    order = np.argsort(scored.score.to_numpy(), kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    n1, n0 = toxic.sum(), (~toxic).sum()
    assert (ranks[toxic.to_numpy()].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) >= 0.95       # area under the curve


def test_held_out_labels_do_not_move_a_score(spark, tmp_path):
    """The labels of held-out rows turned over: every score stays."""
    for name, flip in (("as-is", False), ("flipped", True)):
        path = tmp_path / name
        labels = spark.read.parquet(f"{SF001}/labels.parquet")
        if flip:
            labels = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
        labels.write.parquet(f"{path}/labels.parquet")
        spark.read.parquet(f"{SF001}/documents.parquet").write.parquet(f"{path}/documents.parquet")
    a, b = ({r.doc_id: r.score for r in QUERIES["op8_toxicity"](spark, str(tmp_path / n)).collect()} for n in ("as-is", "flipped"))
    assert a == b and len(set(a.values())) > 10


def test_swapped_texts_score_alike(spark):
    """A name that goes with the toxic label by chance: the penalty takes most of its weight."""
    name, other = next(iter(toxicity._SWAP.items()))
    rows = [(i, ("idiot trash words here " if i % 2 else "a calm and even line ") + (f"{name} " if i % 2 or i % 6 == 0 else "nobody ") + f"w{i % 7}", i % 2)
            for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    gaps = []
    for swap in (0.0, 20.0):
        model = toxicity.fit(docs, labels, swap=swap)
        pair = spark.createDataFrame([(f"a calm {name} line",), (f"a calm {other} line",)], "text string")
        x, y = (r[0] for r in pair.select(toxicity.score(F.col("text"), model)).collect())
        gaps.append(abs(x - y))
    assert gaps[1] < gaps[0] / 2


def test_shards_have_near_equal_bytes(spark):
    """No shard is further from the mean than the largest row, as a row goes whole."""
    got = QUERIES["op1_sharding"](spark, SF001)
    total, largest = got.agg(F.sum("size"), F.max("size")).first()
    sizes = [r[1] for r in got.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(abs(s - total / 8) for s in sizes) <= largest
    assert max(sizes) - min(sizes) <= 0.01 * total / 8


def test_nearest_at_64_dimensions(spark):
    """Recall of the 20 nearest against brute force on the whole table."""
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect() if r.embedding is not None]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got: dict[int, set] = {}
    for r in QUERIES["op5_nearest"](spark, SF01).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[ids == ids[q]] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        hits += len(best & got[int(ids[q])])
        total += 20
    assert x.shape[1] == 64 and hits / total >= 0.9
