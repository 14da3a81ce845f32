import random
import re

import pytest

import __spark_entry__
import corpus_pipeline
from outcomelab.llm import catalog, minhash, mixing, secrets, toxicity

from .conftest import DOCS, prose
from .test_decontamination import brute as brute_phrases
from .test_minhash import brute as brute_components
from .test_minhash import near


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    bad = ["idiot", "moron", "scum", "trash"]
    texts = [prose(k, rng.randrange(20, 120)) for k in range(120)]
    toxic = [int(k % 5 == 0) for k in range(120)]
    for k, t in enumerate(texts):
        if toxic[k]:
            w = t.split()
            for b in rng.sample(bad, 3):
                w.insert(rng.randrange(len(w)), b)
            texts[k] = " ".join(w)
    items = [(k, prose(1000 + k, 20, 90)) for k in range(5)]
    texts += [texts[1], near(texts[2], 1, rng), near(texts[2], 1, rng), texts[3] + "\n" + items[2][1] + " end.",
              items[3][1], texts[4] + " password = 'hunter2hunter' x", texts[6] + " token=Zx81kQp0Lm27", None, "", " "]
    rows = [(k, t, "en", f"o{k % 4}/r", None if t is None else len(t)) for k, t in enumerate(texts)]
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(k, 1, v) for k, v in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(
        f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, toxic, items


def test_stages_against_brute_force(spark, folder, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 120)
    out, toxic, items = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], out))
        if name != "mixing":
            assert tables[-1].columns == docs.columns and tables[-1].dtypes == docs.dtypes
    rows = [{r["doc_id"]: r for r in t.collect()} for t in tables]

    kept = set(rows[1])
    flagged = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(
        docs, spark.read.parquet(f"{out}/labels.parquet").where(~catalog.held_out()))).where("score >= 0.7").collect()}
    assert kept == set(rows[0]) - flagged
    assert len([k for k in range(120) if toxic[k] and k in kept]) <= 3
    assert len([k for k in range(120) if not toxic[k] and k not in kept]) <= 1

    found = brute_components([(k, r["text"]) for k, r in rows[1].items()], 8, 10)
    assert set(rows[2]) == {k for k, _, c in found if k == c}
    assert all(rows[2][k]["text"] == rows[0][k]["text"] for k in rows[2])

    hits = {d: (n, gone) for d, n, gone, _ in brute_phrases([(k, r["text"]) for k, r in rows[2].items()], items)}
    assert set(rows[3]) == {d for d, (n, gone) in hits.items() if not gone or len(gone) < n}
    assert {d for d in rows[3] if rows[3][d]["text"] != rows[2][d]["text"]} == {
        d for d, (n, gone) in hits.items() if gone and len(gone) < n}
    assert all(not gone for _, _, gone, _ in brute_phrases([(k, r["text"]) for k, r in rows[3].items()], items))

    assert set(rows[4]) == set(rows[3])
    for d, r in rows[4].items():
        before = rows[3][d]["text"]
        assert (r["text"] == before) == (not secrets.candidates(before))
        assert not re.search("hunter2|Zx81", r["text"] or "")
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))

    want = {r["doc_id"]: tuple(r) for r in mixing.mix_sources(tables[4]).collect()}
    assert {d: tuple(r) for d, r in rows[5].items()} == want and set(rows[5]) == set(rows[4])
    got = {r["doc_id"]: tuple(r) for r in corpus_pipeline.run(spark, out).collect()}
    assert got == want


def test_empty_documents(spark, folder, tmp_path):
    out, _, _ = folder
    for name in ("documents", "labels", "benchmark"):
        t = spark.read.parquet(f"{out}/{name}.parquet")
        (t.limit(0) if name == "documents" else t).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert minhash.BANDS * minhash.ROWS == minhash.HASHES
