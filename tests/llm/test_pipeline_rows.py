"""Every row that the pipeline's stages give, against brute force, each stage on what the one before kept."""

import re

import corpus_pipeline
import pytest
from test_pii import brute, brute_disclosures

from tripmill.llm import language, packing, pii

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def one_of_each(rows):
    """Ids that stay: the smallest of every group that links of 80 % connect; texts without words stay."""
    sets = {r.doc_id: shingles(r.text) for r in rows}
    group = {k: k for k in sets}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {k for k in keys if top(k) == k}


def sanitised(text, terms):
    edits = [(a, b, f"[{kind.upper()}]") for kind, spans in brute(text).items() for a, b in spans]
    for word, a, b in pii.terms(text, brute(text)):
        if word in terms:
            shape = re.sub(r"[^\W\d_]", "x", re.sub(r"\d", "0", text[a:b]))
            edits.append((a, b, "" if terms[word] >= pii.REMOVE else shape))
    done, at = "", 0
    for a, b, new in sorted(edits):
        if b > at:
            done += text[at:a] + new if a >= at else ""
            at = b
    return done + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage over the whole small table."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, FOLDER)
        after = docs.collect()
        found[name] = (before, after)
        if name != "packing":
            docs = spark.createDataFrame(after, docs.schema)
    return found


def test_no_filtering_stage_changes_or_adds_a_row(stages):
    for name in ("quality_rules", "language", "near_duplicates"):
        before, after = stages[name]
        assert set(after) <= set(before) and len(after) == len(set(after))


def test_languages_keep_what_is_not_rejected(spark, stages):
    before, after = stages["language"]
    docs = spark.createDataFrame(before, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    found = language.predict(docs, language.fit(docs)).collect()
    rejected = {r.doc_id for r in found if r.rejected}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - rejected


def test_near_duplicates_keep_the_first_of_every_group(stages):
    before, after = stages["near_duplicates"]
    assert len(before) > len(after) and {r.doc_id for r in after} == one_of_each(before)


def test_personal_data_is_replaced_and_nothing_else(stages):
    before, after = stages["personal_data"]
    scores = brute_disclosures(r.text for r in before)
    new = {r.doc_id: r.text for r in after}
    assert len(new) == len(before) and any(r.text != new[r.doc_id] for r in before)
    for r in before:
        held = set(pii.entities(r.text, brute(r.text)))
        terms = {}
        for (one, word), score in scores.items():
            if one in held:
                terms[word] = max(score, terms.get(word, 0.0))
        assert new[r.doc_id] == sanitised(r.text, terms)


def test_packing_holds_every_row_with_the_least_padding(stages):
    before, after = stages["packing"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    texts = {r.doc_id: r.text for r in before}
    assert all(r.length == len(WORD.findall(texts[r.doc_id])) <= r.bucket_length for r in after)
    lengths = sorted(r.length for r in after)
    best = [0] + [float("inf")] * len(lengths)  # rows dealt with -> least cost, a bucket more each round
    for _ in range(packing.BUCKETS):
        best = [min([best[j], *(best[i] + lengths[j - 1] * (j - i) for i in range(j))]) for j in range(len(best))]
    assert sum(r.bucket_length for r in after) == best[-1]
