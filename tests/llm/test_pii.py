import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


@settings(deadline=None, max_examples=500)
@given(st.text(alphabet="a.@-_1 2+()%é", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_known_spans_and_long_runs():
    text = "é 4111 1111 1111 1111, +1 (743) 555-3824 x.y@b.c_x@d.e 1.2.3.4.5.6.7.8 300.1.1.1"
    assert pii.base_spans(text) == brute(text)
    for run in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000):
        pii.base_spans(run)


def disclosing(n=12):
    """An address that one nickname goes along with, among addresses of common words."""
    common = "alpha beta gamma delta kappa sigma omega theta".split()
    rows = [(i, f"{common[i % 8]} says zorro{'' if i % 2 else ','} mail boss@corp.example about {common[(i * 3) % 8]} {i}x{i}") for i in range(n)]
    return rows + [(100 + i, f"{common[i % 8]} wrote to u{i}@mail.example about {common[(i * 5) % 8]}") for i in range(60)]


def test_a_disclosing_term_is_found_with_its_entity_only(documents):
    rows = [*disclosing(), (500, "zorro alone says nothing")]
    found = {r.doc_id: r for r in pii.report(documents(*rows, clash=True)).collect()}
    texts = dict(rows)
    for key in range(12):
        spans = [s.split(":") for s in found[key].spans.split(",")]
        terms = {texts[key][int(a) : int(b)].strip(",") for kind, a, b in spans if kind == "term"}
        assert "zorro" in terms and not terms & set("alpha beta gamma delta about".split()) and found[key].n_email == 1
    assert found[500].spans == "" and all(found[100 + i].n_term == 0 for i in range(60))


def test_copies_are_no_evidence(documents):
    rows = [(i, "quixotic person at one@corp.example") for i in range(30)] + disclosing()[12:]
    assert all(r.n_term == 0 for r in pii.report(documents(*rows)).collect())


def test_hard_rows_and_digests(documents, hard_rows):
    rows = [*hard_rows, (9, "a@b.c 1.2.3.4"), (9, "a@b.c 1.2.3.4")]
    found = pii.report(documents(*rows)).collect()
    assert len(found) == len(rows)
    for r in [r for r in found if r.doc_id == 9]:
        assert (r.n_email, r.n_ip, r.spans) == (1, 1, "email:0:5,ip:6:13")
        assert r.base_sha256 == hashlib.sha256(b"email:0:5,ip:6:13").hexdigest()
    assert pii.report(documents(*rows).limit(0)).count() == 0


def test_sanitised_texts(documents):
    rows = [*disclosing(), (200, None), (201, ""), (202, "plain"), (202, "plain")]
    docs = documents(*rows, clash=True)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    found = {r.doc_id: r.text for r in clean.collect()}
    assert found[200] is None and found[202] == "plain"
    assert all("[EMAIL]" in found[i] and "@" not in found[i] and "zorro" not in found[i] for i in range(12))


def test_a_term_far_from_its_entity_goes_as_well(documents):
    filler = " ".join(f"w{k}w" for k in range(40))
    rows = [(i, f"Zorro: title {i}y{i} {filler} write to boss@corp.example {filler} signed zorro") for i in range(6)]
    rows += [(100 + i, f"plain text {i}z{i} {filler}") for i in range(80)]
    found = {r.doc_id: r.spans for r in pii.report(documents(*rows)).collect()}
    clean = {r.doc_id: r.text.lower() for r in pii.sanitise(documents(*rows)).collect()}
    for i in range(6):
        text = rows[i][1]
        named = [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in found[i].split(",")) if kind == "term"]
        assert {"Zorro:", "zorro"} <= set(named) and "zorro" not in clean[i] and "w7w" in clean[i]
    assert all(found[100 + i] == "" for i in range(80))


def test_words_common_in_texts_without_entities_disclose_nothing(documents):
    rows = [(i, f"ordinary {i}x{i} boss@corp.example zorro") for i in range(3)]
    rows += [(100 + i, f"some {i}y{i} u{i}@mail.example") for i in range(30)]
    rows += [(200 + i, f"ordinary {i}z{i} words") for i in range(200)]
    texts = dict(rows)
    for r in pii.report(documents(*rows)).where("doc_id < 3").collect():
        named = {texts[r.doc_id][int(a) : int(b)] for kind, a, b in (s.split(":") for s in r.spans.split(",")) if kind == "term"}
        assert named == {"zorro"}


def test_terms_leave_out_every_word_of_an_entity():
    text = "see 4111 1111 1111 1111, a@b.c/path abc +1 (743) 555-3824x def"
    assert [t for t, _, _ in pii.terms(text, pii.base_spans(text))] == ["see", "abc", "def"]


def brute_disclosures(texts):
    """(text, entity, term) -> disclosure, from the definition: counts over all distinct texts."""
    read = {}
    for text in texts:
        found = pii.base_spans(text or "")
        own = pii.entities(text or "", found)
        some = [t for t, _, _ in pii.terms(text or "", found)]
        read[(tuple(own), " ".join(some))] = (own, set(some))
    n = len(read)
    scores = {}
    for one in {e for own, _ in read.values() for e in own}:
        holding = [some for own, some in read.values() if one in own]
        for term in {t for some in holding for t in some}:
            both = sum(term in some for some in holding)
            alone = sum(term in some for _, some in read.values())
            if both >= pii.SUPPORT and len(holding) < n:
                score = math.log2(both * n / (alone * len(holding))) / math.log2(n / len(holding))
                if score >= pii.GENERALISE:
                    scores[one, term] = score
    return scores


def test_disclosures_equal_brute_force_with_an_entity_in_a_third_of_the_texts(documents):
    dice = random.Random(3)
    words = [f"word{k}" for k in range(60)]
    rows = []
    for i in range(240):
        some = dice.choices(words, k=dice.randrange(1, 12))
        if i % 3 == 0:
            some += ["footer@corp.example", "Imprint", "legal"]
        if i % 7 == 0:
            some += [f"u{i % 5}@mail.example", f"nick{i % 5},"]
        rows.append((i, " ".join(some)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 240, 4)]
    expected = brute_disclosures(t for _, t in rows)
    assert ("email:footer@corp.example", "imprint") in expected and any(t == "nick2" for _, t in expected)
    for r in pii.report(documents(*rows)).collect():
        text = dict(rows)[r.doc_id]
        found = pii.base_spans(text)
        disclosing_here = {t for e, t in expected if e in pii.entities(text, found)}
        wanted = [f"term:{a}:{b}" for t, a, b in pii.terms(text, found) if t in disclosing_here]
        assert [s for s in r.spans.split(",") if s.startswith("term")] == wanted


@settings(deadline=None, max_examples=500)
@given(st.text(alphabet="aB1_.,-é ²\t\n\x1c\u00a0\u2003Ω'", max_size=40))
def test_terms_of_a_text_are_the_same_by_words_and_by_bytes(text):
    assert pii.terms_of(text) == [t for t, _, _ in pii.terms(text, {})]
    edge = re.compile(r"^\W+|\W+$")
    plain = [edge.sub("", w).lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    assert pii.terms_of(text) == [t for t in plain if len(t) >= 3 and not t.isdigit()]


def test_terms_of_long_words():
    long = "x" * 300
    assert pii.terms_of(f"({long}) abc") == [long, "abc"]
