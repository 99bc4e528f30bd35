"""Personal data: fixed patterns, and terms that give an entity away.

Patterns find e-mail addresses, IP addresses, card and phone numbers. Beyond them, a term that
stands in the texts of an entity much more often than chance would have it discloses that entity
although it is no personal data itself. Its disclosure is the pointwise mutual information of term
and entity, as a share of the entity's own information: 1 means that the term names the entity
outright. Terms over REMOVE are removed, terms over GENERALISE are replaced by their shape, and both
wherever they stand in the texts that hold the entity, and only there. Counts are over the distinct
texts of all documents, with and without entities, so copies of one text are no evidence.

Defined results: a null text is an empty one and has no spans; repeated rows are treated row by row;
a text of any length is one row and is never cut; an empty table gives no rows. Only the id and the
results are returned, or, from ``sanitise``, all columns with the text replaced.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.jaccard import FILTER_BITS, may_be_named, name_filter
from tripmill.llm.shared import discard, map_arrow, portions, row_hash, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Longest word whose term workers remember, and how many they remember.
SHORT = 64
REMEMBERED = 1 << 14
# Distinct texts that must show a term with an entity.
SUPPORT = 3
GENERALISE = 0.75
REMOVE = 0.9

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: what fails there fails inside it as well.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int]
TERMS = "array<struct<start:long,end:long,disclosure:double>>"


def emails(text: str) -> list[Span]:
    """Found from each @ outwards, which is linear in the text."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            last = match.end()
        at = text.find("@", max(at + 1, last))
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of every kind in code points; matches that fail a kind's test are dropped."""
    spans = lambda pattern, good: [m.span() for m in pattern.finditer(text) if good(m.group())]
    return {
        "email": emails(text),
        "ip": spans(IP, _is_ip),
        "card": spans(CARD, _is_card),
        "phone": spans(PHONE, _is_phone) if "+" in text else [],
    }


def entity(kind: str, text: str) -> str:
    """One form for all spellings of an entity."""
    return f"{kind}:{text.lower() if kind == 'email' else text if kind == 'ip' else _digits(text)}"


def term(word: str) -> str:
    """The word's term, without symbols at its ends; empty if it has none."""
    if not word.isalnum():
        start, end = 0, len(word)
        while start < end and not (word[start].isalnum() or word[start] == "_"):
            start += 1
        while end > start and not (word[end - 1].isalnum() or word[end - 1] == "_"):
            end -= 1
        word = word[start:end]
    cleaned = word.lower()
    return cleaned if len(cleaned) >= 3 and not cleaned.isdigit() else ""


@lru_cache(maxsize=REMEMBERED)
def short_term(word: bytes) -> str:
    return term(word.decode("utf-8", "surrogatepass"))


def terms_of(text: str) -> list[str]:
    """Every term of a text without entities. Bytes are split at the same six blanks as WORD."""
    words = text.encode("utf-8", "surrogatepass").split()
    if max(map(len, words), default=0) <= SHORT:
        return [t for t in map(short_term, words) if t]
    return [t for t in (short_term(w) if len(w) <= SHORT else term(w.decode("utf-8", "surrogatepass")) for w in words) if t]


def terms(text: str, found: dict[str, list[Span]]) -> Iterator[tuple[str, int, int]]:
    """Every term of the text with its span; words that overlap an entity are none."""
    spans = iter(sorted(span for each in found.values() for span in each))
    taken, ahead = 0, next(spans, None)  # end of the spans that start before the word's end
    for match in WORD.finditer(text):
        a, b = match.span()
        while ahead and ahead[0] < b:
            taken, ahead = max(taken, ahead[1]), next(spans, None)
        if taken > a:
            continue
        cleaned = term(match.group())
        if cleaned:
            yield cleaned, a, b


def entities(text: str, found: dict[str, list[Span]]) -> list[str]:
    return sorted({entity(kind, text[a:b]) for kind, spans in found.items() for a, b in spans})


def text_name(own: list[str], some: list[str]) -> bytes:
    """A hash of a text's entities and of its terms in order, so copies that differ in case,
    punctuation or short words are one text."""
    return hashlib.md5("\n".join([*own, " ".join(some)]).encode("utf-8", "replace")).digest()


def read(text: str) -> tuple[list[str], list[str]]:
    """Entities of a text, and its terms in order."""
    found = base_spans(text)
    if not any(found.values()):
        return [], terms_of(text)
    return entities(text, found), [t for t, _, _ in terms(text, found)]


def term_bit(value: str) -> int:
    """The bit of ``value`` in a filter over ``checksum``."""
    return zlib.crc32(value.encode("utf-8", "replace")) % FILTER_BITS


def checksum(value: Column) -> Column:
    return F.crc32(value.cast("binary"))


def passes(bits: bytes, value: str) -> bool:
    at = term_bit(value)
    return bool(bits[at >> 3] >> (at & 7) & 1)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans, counts and, for a text with entities, its name. One narrow stage.

    Spans are in the row of their text and grow with its entities only.
    """
    names = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, named = [[] for _ in KINDS], [], []
            for value in batch.column(1).to_pylist():
                value = value or ""
                found = base_spans(value)
                for column, kind in zip(counts, KINDS):
                    column.append(len(found[kind]))
                base.append(",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in found[kind]))
                own = entities(value, found)
                named.append(text_name(own, [t for t, _, _ in terms(value, found)]) if own else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(named, pa.binary()), batch.column(2)],
                names=["key", *names, "base", "name", "row"],
            )

    schema = f"key {docs.schema[key].dataType.simpleString()}, " + "".join(f"{n} long, " for n in names) + "base string, name binary, row long"
    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), row_hash(key, text).alias("row"))
    return map_arrow(chosen, run, schema)


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(name, entities, words) of the distinct texts; ``words``, the distinct terms joined by blanks,
    only where there are entities. Copies are combined before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [t or "" for t in batch.column(0).to_pylist()]
            for part in portions(values):
                names, held, words = [], [], []
                for value in values[part]:
                    own, some = read(value)
                    names.append(text_name(own, some))
                    held.append(own)
                    words.append(" ".join(sorted(set(some))) if own else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(held, pa.list_(pa.string())), pa.array(words, pa.string())], names=["name", "entities", "words"]
                )

    found = map_arrow(docs.select(F.col(f"`{text}`").alias("text")), run, "name binary, entities array<string>, words string")
    return found.dropDuplicates(["name"])


def term_counts(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """(term, n_term): in how many distinct texts of all documents each of the ``wanted`` terms stands.

    A filter of fixed size leaves out nearly all other terms where the texts are read; the few it lets
    through besides are counted as well. A batch of texts makes one row a term.
    """
    bits = docs.sparkSession.sparkContext.broadcast(name_filter(wanted.select(checksum(F.col("term")).alias("sum")), "sum"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_bits = bits.value
        known = lru_cache(maxsize=REMEMBERED)(lambda t: passes(own_bits, t))
        for batch in batches:
            values = [t or "" for t in batch.column(0).to_pylist()]
            for part in portions(values):
                names, held = [], []
                for value in values[part]:
                    own, some = read(value)
                    if chosen := [t for t in set(some) if (known(t) if len(t) <= SHORT else passes(own_bits, t))]:
                        names.append(text_name(own, some))
                        held.append(sorted(chosen))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(held, pa.list_(pa.string()))], names=["name", "terms"])

    found = map_arrow(docs.select(F.col(f"`{text}`").alias("text")), run, "name binary, terms array<string>").dropDuplicates(["name"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = batch.column(0).flatten().value_counts().flatten()
            yield pa.RecordBatch.from_arrays([values, counts.cast(pa.int64())], names=["term", "n"])

    return map_arrow(found.select("terms"), summed, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosure(n_term: str) -> Column:
    """Pointwise mutual information as a share of the entity's own; it falls as ``n_term`` grows."""
    mutual = F.log2(F.col("n_both") * F.col("n") / (F.col(n_term) * F.col("n_entity")))
    own = F.log2(F.col("n") / F.col("n_entity"))
    return F.when(own > 0, mutual / own).otherwise(0.0)


def disclosing_terms(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """(name, own), and where it is stored: for every distinct text the terms that disclose an entity
    it holds, with their disclosure, the highest over its entities.

    Candidates come first: terms that stand in SUPPORT distinct texts of one entity and whose count
    over the texts with entities alone does not rule them out already, as the whole count is no
    smaller. Only those are counted over the distinct texts of all documents. Pairs of entity and
    term stay rows throughout, and sums are combined before each shuffle, so a frequent entity or
    term costs one row a task; a text ends with no more than its own distinct terms.
    """
    spark = docs.sparkSession
    texts, texts_folder = stored(distinct_texts(docs, text), "pii-texts")
    total = texts.count()
    pairs = texts.select("name", F.explode("entities").alias("entity"))
    whole = pairs.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    whole, whole_folder = stored(whole, "pii-entities")
    # A name is found once in ``texts``, so neither side of this join has a hot key.
    held = pairs.join(whole.select("entity"), "entity").groupBy("name").agg(F.collect_list("entity").alias("held"))
    near, near_folder = stored(texts.select("name", "words").join(held, "name"), "pii-near")
    by_term = near.select("held", F.explode(F.split("words", " ")).alias("term")).where(F.col("term") != "")
    both = by_term.select(F.explode("held").alias("entity"), "term").groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    both = both.where(F.col("n_both") >= SUPPORT).join(whole, "entity").withColumn("n", F.lit(total))
    seen = texts.where("words is not null").select(F.explode(F.split("words", " ")).alias("term")).groupBy("term").agg(F.count("*").alias("n_seen"))
    both = both.join(seen, "term").where(disclosure("n_seen") >= GENERALISE).drop("n_seen")
    both, both_folder = stored(both, "pii-both")
    discard(spark, texts_folder)
    discard(spark, whole_folder)
    wanted, wanted_folder = stored(both.select("term").distinct(), "pii-wanted")
    scored = both.join(term_counts(docs, wanted, text), "term").withColumn("disclosure", disclosure("n_term"))
    found = scored.where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")
    found, found_folder = stored(found, "pii-found")
    discard(spark, both_folder)
    discard(spark, wanted_folder)
    spread, spread_folder = stored(_by_text(near, found), "pii-by-text")
    discard(spark, near_folder)
    discard(spark, found_folder)
    return spread, spread_folder


def _by_text(near: DataFrame, found: DataFrame) -> DataFrame:
    """(name, own) from the rows of entity and term of every text; a filter of fixed size leaves out
    nearly all that disclose nothing before any row is made of them."""
    together = checksum(F.concat_ws("\n", "entity", "term"))
    bits = near.sparkSession.sparkContext.broadcast(name_filter(found.select(together.alias("sum")), "sum"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_bits = bits.value
        for batch in batches:
            for name, words, held in zip(batch.column(0), batch.column(1), batch.column(2)):
                words = [w for w in words.as_py().split(" ") if w]
                for own in held.as_py():
                    chosen = [w for w in words if passes(own_bits, f"{own}\n{w}")]
                    if chosen:
                        kinds = [pa.binary(), pa.string(), pa.string()]
                        columns = [[name.as_py()] * len(chosen), [own] * len(chosen), chosen]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["name", "entity", "term"])

    rows = map_arrow(near.select("name", "words", "held"), run, "name binary, entity string, term string")
    best = rows.join(found, ["entity", "term"]).groupBy("name", "term").agg(F.max("disclosure").alias("disclosure"))
    return best.groupBy("name").agg(F.collect_list(F.struct("term", "disclosure")).alias("own"))


def term_spans(scanned: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, terms) with the spans of disclosing terms anywhere in the texts that hold their entity."""
    spark = docs.sparkSession
    own, own_folder = disclosing_terms(docs, text)
    holders = scanned.where("name is not null").select("row", "name").distinct()
    wanted, wanted_folder = stored(holders.join(own, "name").select("row", "own"), "pii-rows")
    discard(spark, own_folder)
    # A filter of fixed size keeps nearly all other texts out of the join.
    named = spark.sparkContext.broadcast(name_filter(wanted, "row"))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_be_named(named.value, batch.column(0).to_numpy())))

    texts = map_arrow(docs.select(row_hash(key, text).alias("row"), F.col(f"`{text}`").alias("text")), passed, "row long, text string")
    chosen = texts.join(wanted, "row").dropDuplicates(["row"]).select("row", "text", "own")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("disclosure", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for value, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                highest = {t["term"]: t["disclosure"] for t in own}
                every = terms(value, base_spans(value))
                spans.append([{"start": a, "end": b, "disclosure": highest[t]} for t, a, b in every if t in highest])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["row", "terms"])

    spans, _ = stored(map_arrow(chosen, run, f"row long, terms {TERMS}"), "pii-spans")
    discard(spark, wanted_folder)
    return spans


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All spans of every text: key, counts, ``base`` and ``terms``.

    The result reads two stored tables, of spans only, which are all that is left behind.
    """
    scanned, _ = stored(scan(docs, key, text), "pii-scan")
    spans = term_spans(scanned, docs, key, text)
    return scanned.drop("name").join(spans, "row", "left").drop("row").withColumn("terms", F.coalesce("terms", F.array().cast(TERMS)))


def spans_text(base: Column, terms: Column) -> Column:
    """All spans as kind:start:end, kinds as listed and terms last, each by start."""
    lines = F.transform(terms, lambda t: F.concat_ws(":", F.lit(TERM), t["start"], t["end"]))
    return F.concat_ws(",", F.when(base != "", base), F.when(F.size(terms) > 0, F.array_join(lines, ",")))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = find(docs, key, text)
    return found.select(
        F.col("key").alias(key),
        *(f"n_{kind}" for kind in KINDS),
        F.size("terms").cast("long").alias("n_term"),
        F.sha2("base", 256).alias("base_sha256"),
        spans_text(F.col("base"), F.col("terms")).alias("spans"),
    )


def replaced(text: str, terms: list[dict]) -> str:
    """The text with entities named by kind, and terms removed or reduced to their shape."""
    edits = [(a, b, f"[{kind.upper()}]") for kind, spans in base_spans(text).items() for a, b in spans]
    for t in terms:
        shape = "" if t["disclosure"] >= REMOVE else re.sub(r"[^\W\d_]", "x", re.sub(r"\d", "0", text[t["start"] : t["end"]]))
        edits.append((t["start"], t["end"], shape))
    parts, at = [], 0
    for a, b, new in sorted(edits):
        if b <= at:
            continue  # inside an edit of another kind
        parts += [text[at:a], new] if a >= at else []
        at = b
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns with the text sanitised; a null text stays null."""
    scanned, scanned_folder = stored(scan(docs, key, text).where("name is not null").select("row", "name"), "pii-scan")
    spans = term_spans(scanned, docs, key, text)
    discard(docs.sparkSession, scanned_folder)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    rows = docs.withColumn("__row", row_hash(key, text)).toDF(*names, "row").join(spans, "row", "left").select(*names, "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            pairs = zip(columns[at].to_pylist(), columns[-1].to_pylist())
            columns[at] = pa.array([None if t is None else replaced(t, terms or []) for t, terms in pairs], pa.string())
            yield pa.RecordBatch.from_arrays(columns[:-1], names=names)

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    return map_arrow(rows, run, schema).toDF(*docs.columns)
