import numpy as np
import pytest
import zlib

from tripmill.llm import language

WORDS = {
    "en": "the house with many windows stands near the river and shines in the morning".split(),
    "de": "das große Haus steht am Fluss und glänzt schön über den Dächern im Morgenlicht".split(),
    "fr": "la grande maison près de la rivière brille où les fenêtres étaient fermées".split(),
}


def corpus(n=60, seed=1):
    rng = np.random.default_rng(seed)
    return [
        (i, " ".join(rng.choice(WORDS[lang], 25)), lang) for i, lang in enumerate(lang for _ in range(n) for lang in WORDS)
    ]


def test_held_out_accuracy_and_fold(documents):
    docs = documents(*corpus(), clash=True)
    found = language.predict(docs, language.fit(docs), ["doc_id", "lang"]).withColumn("held_out", language.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 10 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and not r.rejected for r in found)


def test_labels_of_held_out_rows_are_not_used(documents):
    rows = corpus()
    lied = [(k, t, "xx" if zlib.crc32(str(k).encode()) % 5 == 0 else lang) for k, t, lang in rows]
    model = language.fit(documents(*lied))
    assert "xx" not in model["langs"] and model["langs"].count("en") == language.CLUSTERS


def test_hard_rows(documents, hard_rows):
    docs = documents(*corpus(), *((None if r[0] is None else r[0] + 1_000, *r[1:]) for r in hard_rows))
    found = language.predict(docs, language.fit(docs)).collect()
    assert len(found) == 180 + len(hard_rows)
    unknown = [r for r in found if r.lang_pred == "und"]
    assert {r.doc_id for r in unknown} == {1001, 1002, 1003, None} and all(r.score == 0 and r.rejected for r in unknown)


def test_a_foreign_script_is_rejected(documents):
    docs = documents(*corpus())
    other = documents((1, "これは日本語の文章です。まったく違う文字で書かれています。"))
    assert language.predict(other, language.fit(docs)).first().rejected


def test_nothing_to_learn_from(documents):
    docs = documents((1, "text", None))
    assert language.predict(docs, language.fit(docs)).first().lang_pred == "und"
    none = docs.limit(0)
    assert language.predict(none, language.fit(none)).count() == 0


def test_chunks_lose_nothing(monkeypatch):
    text = "Große Häuser und schöne Gärten " * 30
    whole = language.counts(text)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert (language.counts(text) == whole).all()


def test_a_language_of_any_size_is_sampled():
    for n in (1, 600, 10**6, 629_145_601, 10**12):
        expected = n * language.sample_limit(n) / language.HASHES
        assert abs(expected - min(n, language.SAMPLE)) < 1e-3


def test_rows_without_letters_do_not_thin_the_sample(documents, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 6)
    blank = [(1_000 + i, None if i % 2 else "12 34", lang) for i, lang in enumerate(lang for _ in range(1_000) for lang in WORDS)]
    model = language.fit(documents(*corpus(), *blank))
    assert {lang for lang in model["langs"]} == set(WORDS)


def test_a_language_without_a_centroid_raises(documents, monkeypatch):
    monkeypatch.setattr(language, "sample_limit", lambda n: 0)
    with pytest.raises(RuntimeError, match="no centroid for de, en, fr"):
        language.fit(documents(*corpus()))


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben kell hogy viseltessenek.",
]


def test_unlearned_latin_languages_and_gibberish_are_rejected_and_short_texts_kept(documents):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(WORDS[lang], int(rng.integers(1, 200)))), lang) for i, lang in enumerate(list(WORDS) * 200)]
    # A junk row in two hundred must not widen the radius.
    rows += [(5_000 + i, " ".join("".join(map(chr, 97 + rng.integers(0, 26, 7))) for _ in range(100)), "en") for i in range(3)]
    model = language.fit(documents(*rows))
    noise = " ".join("".join(map(chr, 97 + rng.integers(0, 26, 6))) for _ in range(400))
    bad = language.predict(documents(*enumerate([*FOREIGN, noise])), model).collect()
    assert all(r.rejected for r in bad)
    clean = language.predict(documents(*rows[:600]), model).where("rejected").count()
    assert clean <= 3
    few = [(i, " ".join(WORDS[lang][2 : 3 + k])) for i, (lang, k) in enumerate((lang, k) for lang in WORDS for k in range(4))]
    assert language.predict(documents(*few), model).where("rejected").count() <= 1
