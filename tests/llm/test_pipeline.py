"""Each stage of the corpus pipeline on what the stage before kept, against brute force."""

import collections
import re

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from weirline.llm import packing, secret_scan
from weirline.llm._common import materialize


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", None), (-2, "", "en", "s", 0), (-3, "123 456", "en", "s", 7)], docs.schema)
    out = [docs.unionByName(extra)]
    for _, f in corpus_pipeline.STAGES:
        out.append(materialize(f(spark, out[-1], sf), "stage"))
    return out


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_only_texts_without_letters_are_rejected(stages):
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in stages[:2])
    assert set(before) - set(after) == {k for k, t in before.items() if not re.search(r"[^\W\d_]", t or "")} and set(before) - set(after) >= {-1, -2, -3}


def test_one_of_each_group_of_copies_stays(stages):
    groups = collections.defaultdict(list)
    for r in stages[1].collect():
        groups[r.text.translate({c: c + 32 for c in range(65, 91)})].append(r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(map(max, groups.values()))


def test_near_copies_go_and_others_stay(stages):
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    kept = {r.doc_id for r in stages[3].collect()}
    words = {k: t.lower().split() for k, t in texts.items()}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, w in words.items()}
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert kept == {k for k in sets if top(k) == k}


def test_secrets_are_gone_and_no_document(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[3:5])
    assert set(before) == set(after)
    for k, r in after.items():
        spans = secret_scan.scan([before[k].text])[0]
        assert r.text == (secret_scan.redact(before[k].text, spans) if spans else before[k].text) and r.n_chars == len(r.text)


def test_everything_is_packed(stages):
    assert {r.doc_id for r in stages[5].select("doc_id").distinct().collect()} == {r.doc_id for r in stages[4].collect()}
    bins = collections.defaultdict(int)
    for r in stages[5].collect():
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 4096 and len(bins) <= -(-sum(bins.values()) // 4096) + 1


NAMES = "doc_id long, text string, lang string, source string, n_chars long"


def chain(spark, docs):
    """All stages but for writing between them; the rows after each."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        out[name] = docs.collect()
    return out


def test_stages_take_an_empty_table(spark):
    out = chain(spark, spark.createDataFrame([], NAMES))
    assert all(rows == [] for rows in out.values())


def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    prose = "the house of the town and the garden of the house by the river in the valley"
    rows = [(None, prose, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "123 !!", "en", "a", 6), (4, prose, "en", "a", 5), (4, prose, "en", "a", 5), (5, prose.upper(), None, "b", None), (6, "token = abcdef123456 and some words here", None, None, None)]
    clashes = ["shard", "node", "k", "hit", "digest", "best", "rec", "lang_pred", "score", "length", "row", "size", "sequence_id"]
    docs = spark.createDataFrame(rows, NAMES)
    for c in clashes:
        docs = docs.withColumn(c, F.lit("x"))
    out = chain(spark, docs)
    ids = {name: sorted((r["doc_id"] for r in rows), key=repr) for name, rows in out.items()}
    assert ids == {"language": [4, 4, 5, 6, None], "exact": [5, 6], "near": [5, 6], "secrets": [5, 6], "pack": [5, 6]}
    assert all(list(r.asDict()) == docs.columns for name in ("language", "exact", "near", "secrets") for r in out[name])
    assert next(r for r in out["secrets"] if r["doc_id"] == 6)["text"].startswith("[REDACTED:assign]") and {r["lang"] for r in out["language"]} == {"en"}


def test_the_language_stage_decides_what_is_packed_together(spark):
    words = {"en": "the house of garden and water with many small rooms for old people", "de": "das haus mit dem garten und wasser hat viele kleine zimmer und alte leute"}
    texts = {i: (" ".join([words[lang]] * 2 + [f"{lang}{i}"] + sorted(words[lang].split(), key=lambda w: len(w) * i % 7)), lang) for i, lang in enumerate(["en", "de"] * 20)}
    rows = [(i, t, "en" if i in (1, 3) else None if i == 5 else lang, "s", len(t)) for i, (t, lang) in texts.items()]
    docs = spark.createDataFrame(rows, NAMES)
    seen = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert seen == {i: lang for i, (_, lang) in texts.items()}, "wrong and missing labels are those of the text"
    labelled = corpus_pipeline.language(spark, docs, "")
    packed = packing.pack_documents(labelled, capacity=128, group_col="lang").collect()
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length, r.lang))
    assert all(r.lang == seen[r.doc_id] for r in packed) and sum(len({b[2] for b in held}) > 1 for held in bins.values()) <= 1
    for held in bins.values():
        ends = [0, *(o + n for o, n, _ in sorted(held))]
        assert [o for o, _, _ in sorted(held)] == ends[:-1] and ends[-1] <= 128


def test_groups_share_only_their_rests():
    counts = {("a", 10): 25, ("b", 10): 13, ("b", 7): 1, ("c", 3): 2}
    entries, moved = packing.plan_groups(counts, 100)
    fill, langs = collections.defaultdict(set), collections.defaultdict(set)
    for (group, n), (rank, first, offset) in entries.items():
        for r in range(counts[group, n]):
            k = max(i for i, x in enumerate(rank) if x <= r)
            b, o = int(first[k] + r - rank[k]), int(offset[k])
            b, o = (moved[b][0], o + moved[b][1]) if b in moved else (b, o)
            places = set(range(o, o + n))
            assert not places & fill[b]
            fill[b] |= places
            langs[b].add(group)
    assert len(fill) == 4 and sum(map(len, langs.values())) == 6 and all(f == set(range(len(f))) and len(f) <= 100 for f in fill.values())
