import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from seqloom.llm import mixing, toxicity
from seqloom.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_contract(spark):
    docs = read(spark, SF, "documents")
    names = docs.columns
    kept = {r["doc_id"] for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF).cache()
        assert docs.columns == names, name
        now = {r["doc_id"] for r in docs.collect()}
        assert now and now <= kept, name
        if name == "secrets":
            assert now == kept
            assert not [r for r in docs.collect() if re.search("AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r["text"])]
        kept = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == kept


def test_run_and_empty_documents(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = read(spark, SF, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert docs.count() == 0


def test_odd_rows_pass_all_stages(spark):
    """Nulls, empty and long texts, repeats, shared ids and clashing columns; every stage does what its docstring says."""
    from test_operators import DOCS, EXTRA, odd_rows, shared_ids

    given = odd_rows() + [(i, t, None, "s9", None) for i, t in shared_ids()] + [(500, "word " * 60_000 + "token: abcdefgh1", "en", "s0", 300_016)]
    docs = spark.createDataFrame(given, DOCS).withColumns({c: F.lit("clash") for c in EXTRA})
    names, before = docs.columns, len(given)
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF).cache()
        assert docs.columns == names, name
        now = docs.count()
        assert 0 < now <= before and (name != "secrets" or now == before), name
        if name == "near_copies":
            assert docs.where("doc_id is null").count() == 5
        before = now
    assert "[SECRET]" in docs.where("doc_id = 500").first()["text"] or docs.where("doc_id = 500").first()["n_chars"] < 300_000
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}


BASE = (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), re.compile("AKIA[A-Z0-9]{12,}"), re.compile("[0-9a-f]{32,}"))


def near_copies(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return [i for i in sets if root(i) == i]


def redacted(text):
    spans = sorted((m.start(), m.end()) for k, p in enumerate(BASE) for m in p.finditer(text) if k or len(m[2]) >= 8)
    out, at = "", 0
    for s, e in spans:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_run_equals_plain_version(spark):
    """All stages but the scores themselves, written plainly."""
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    clean = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 0").collect()}
    table = docs.toPandas().set_index("doc_id")
    texts = {i: t for i, t in table["text"].items() if i in clean}
    texts = {i: redacted(texts[i]) for i in near_copies(texts)}
    documents = table.loc[list(texts)].assign(text=list(texts.values())).reset_index()
    c = duckdb.connect()
    c.register("documents", documents)
    taken = {i: (n if epochs else prefix) for i, _, _, _, n, epochs, prefix in c.execute(mixing.oracle(mixing.Mix(percent=90, max_epochs=1))).fetchall()}
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, n in taken.items():
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", texts[i]))
        text = texts[i] if n == len(words) else texts[i][: words[n].start()]
        want[i] = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(want)
    for i, pieces in got.items():
        assert sum(p["length"] for p in pieces) == len(want[i])
        for p in pieces:
            assert p["ids_crc32"] == zlib.crc32(want[i][p["start"] : p["start"] + p["length"]].tobytes()), i
