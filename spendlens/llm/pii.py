"""Personal data: base patterns, and terms that reveal what they found.

1. Four patterns find e-mail addresses, IP addresses, card and phone numbers in
   every whole text. Each distinct value is a protected entity.
2. A term (a word of at least ``LEAST_CHARS`` letters) co-occurs with an entity if
   it stands within ``WINDOW`` words of a mention, so a document gives a number of
   pairs that is linear in its mentions.
3. Pairs, entities, terms and all texts are counted over one population: distinct
   texts of the whole corpus. What a reader of the term still lacks to name the entity
   is -log2 p(e | t) bits. As few texts prove little, p(e | t) is the lower limit of
   Wilson's interval at ``LIMIT`` standard errors, the term's ``disclosure``:

       n / (n + 1) for a term that occurs in n texts, always with the entity

   It depends on the texts of the term alone, so the verdict is the same in a small and
   a large corpus. A term that does not tell at least one bit about the entity
   (p(e | t) >= 2 p(e)) discloses nothing.
4. In all documents, with the entity or without it, all occurrences of a term with a
   disclosure of at least ``GENERALISE`` (at most one bit is lacking) for any entity are
   generalised to their shape, and removed from ``REMOVE`` on (a third of a bit). So a
   term of one text can be generalised, and takes four texts to be removed. Base spans
   are masked by their kind.

Base spans are never dropped for term spans; a term inside a base span adds none.
Documents with neither stay as they are. Null texts are empty. Repeated rows
get a row each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import materialize
from .common import by_slices, number_of, table, text_of

KINDS = ("email", "ip", "card", "phone")
WINDOW = 10
LEAST_CHARS = 4
LIMIT = 1.0
GENERALISE = 0.5
REMOVE = 0.8
SHAPE_RUN = 3
FLUSH = 300_000
FILTER_BITS = 1 << 25
MAX_WORDS = 500_000

# The patterns take whole runs at once and start only where a run starts, so a text
# without white space costs no more than any other.
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]++")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W\d_]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all matches that hold, by kind, then start."""
    found = []
    if "@" in text:
        at = 0
        for run in _LOCAL_RUN.finditer(text):
            # A run before an @ is the local part; a domain's own characters are used up.
            start, end = max(run.start(), at), run.end()
            if start < end and text.startswith("@", end) and (domain := _DOMAIN.match(text, end)):
                at = domain.end()
                found.append((0, start, at))
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match.group().split(".")):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", match.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
                found.append((3, *match.span()))
    return found


def entity(text: str, span: tuple[int, int, int]) -> int:
    """A 64-bit name of the value, whatever its case and separators."""
    kind, start, end = span
    value = text[start:end].lower()
    value = value if kind < 2 else _NOT_DIGIT.sub("", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


def _terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """Terms outside the spans, in order, with their places."""
    covered = sorted((start, end) for _, start, end in spans)
    out, i = [], 0
    for match in _TERM.finditer(text):
        while i < len(covered) and covered[i][1] <= match.start():
            i += 1
        if match.end() - match.start() >= LEAST_CHARS and not (i < len(covered) and covered[i][0] < match.end()):
            out.append((match.group().lower(), *match.span()))
    return out


def contexts(text: str, spans: list[tuple[int, int, int]]) -> set[tuple[int, str]]:
    """(entity, term) pairs of a text."""
    import bisect
    terms = _terms(text, spans)
    starts = [t[1] for t in terms]
    pairs = set()
    for span in spans:
        name, at = entity(text, span), bisect.bisect_left(starts, span[1])
        pairs.update((name, t[0]) for t in terms[max(0, at - WINDOW):at + WINDOW])
    return pairs


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of every text."""
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = []
        for text in batch.column("text").to_pylist():
            found = base_spans(text)
            pairs.append([{"entity": e, "term": t} for e, t in contexts(text, found)] if found else [])
        return pa.RecordBatch.from_arrays(
            [batch.column("same"), pa.array(pairs, pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string())])))],
            ["same", "pairs"])
    return by_slices(batches, make)


_MENTIONS = "same long, pairs array<struct<entity:long,term:string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND = "row long, doc_id long, text string, base array<struct<kind:int,start:int,end:int>>, terms array<string>"


class _Told(dict):
    """Whether a word may be a disclosing term, by a filter of fixed size."""

    def __init__(self, bitmap: np.ndarray):
        self.bitmap = bitmap

    def __missing__(self, word: str) -> bool:
        if len(self) >= MAX_WORDS:
            self.clear()
        # The hash that xxhash64() of Spark gives, which is signed there.
        value = self[word] = len(word) >= LEAST_CHARS and _may_hold(
            self.bitmap, xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"), 42))
        return value


def _find(bitmap):
    """Base spans of every row, the words that may disclose, and the text where there are any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = _Told(bitmap.value)

        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans, terms, kept = [], [], []
            for text in batch.column("text").to_pylist():
                found = base_spans(text)
                words = sorted({w.lower() for w in set(_TERM.findall(text)) if told[w]})
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                terms.append(words)
                kept.append(text if found or words else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(spans, _SPAN),
                 pa.array(terms, pa.list_(pa.string()))], ["row", "doc_id", "text", "base", "terms"])
        return by_slices(batches, make)
    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit per 64-bit hash (column ``h``); its size does not depend on the rows."""
    at = f"pmod(h, {FILTER_BITS})"
    found = hashes.selectExpr(f"shiftright({at}, 5) as word", "shiftleft(1L, cast(pmod(h, 32) as int)) as bit").groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _may_hold(bitmap: np.ndarray, h: int) -> bool:
    at = h % FILTER_BITS
    return bool(int(bitmap[at >> 5]) >> (at & 31) & 1)


def _distinct_texts(docs: DataFrame, counted: DataFrame) -> list[DataFrame]:
    """Texts of the corpus, each once, in two parts. Only texts that may have copies by a
    filter of fixed size are shuffled; the others are read where they lie."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(counted.where("times > 1").select(F.col("same").alias("h"))))

    def part(copied: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = [_may_hold(shared.value, h) is copied for h in batch.column("same").to_pylist()]
                yield batch.filter(pa.array(mask, pa.bool_()))
        return docs.select("same", "text").mapInArrow(run, "same long, text string")

    return [part(False).select("text"), part(True).groupBy("same").agg(F.first("text").alias("text")).select("text")]


def _words_of(text: str) -> set[str]:
    return {w.lower() for w in set(_TERM.findall(text)) if len(w) >= LEAST_CHARS}


def _corpus_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of texts by term."""
    def out(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "rows"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(_words_of(text))
            if len(counts) > FLUSH:
                yield out(counts)
                counts = Counter()
    yield out(counts)


def lower_limit(both: Column, rows: Column, z: float = LIMIT) -> Column:
    """Wilson's lower limit of both / rows."""
    p = both / rows
    middle = p + z * z / (2 * rows)
    return (middle - z * F.sqrt(p * (1 - p) / rows + z * z / (4 * rows * rows))) / (1 + z * z / rows)


def shape(term: str) -> str:
    """Letters by their case, with long runs cut: what is left of a generalised term."""
    out = ""
    for letter in term:
        mark = "X" if letter.isupper() else "x"
        if not out.endswith(mark * SHAPE_RUN):
            out += mark
    return f"[{out}]"


def disclosing_terms(docs: DataFrame, found: DataFrame, limit: float = LIMIT, least: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) over the distinct texts of the corpus. ``docs``: same, text;
    ``found``: same, pairs of every row."""
    counted = materialize(found.groupBy("same").agg(F.count("*").alias("times")), "pii-texts")
    n = F.lit(float(max(counted.count(), 1)))
    distinct = found.where(F.size("pairs") > 0).groupBy("same").agg(F.first("pairs").alias("pairs"))
    pairs = materialize(distinct.select("same", F.explode("pairs").alias("p")).select("same", "p.entity", "p.term"), "pii-pairs")
    together = pairs.groupBy("entity", "term").agg(F.count("*").alias("both"))
    entities = pairs.select("entity", "same").distinct().groupBy("entity").agg(F.count("*").alias("mentions"))
    share = F.col("mentions") / n

    def disclosure(rows):
        told = lower_limit(F.col("both").cast("double"), rows.cast("double"), limit)
        return F.when(told >= 2 * share, told).otherwise(F.lit(0.0))

    # A term stands in as many texts as the pair at least; what fails with as few fails with more.
    candidates = materialize(together.join(entities, "entity").where(disclosure(F.col("both")) >= least), "pii-candidates")
    terms = candidates.select("term").distinct()
    once, copied = _distinct_texts(docs, counted)
    corpus = once.union(copied).mapInArrow(_corpus_terms, "term string, rows long").join(
        terms, "term", "left_semi").groupBy("term").agg(F.sum("rows").alias("rows"))
    return candidates.join(corpus, "term").select("entity", "term", disclosure(F.col("rows")).alias("disclosure")).where(
        F.col("disclosure") >= least)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All spans and the sanitised text of documents with base spans or disclosing terms."""
    names = [*KINDS, "term"]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans_out, texts = [], []
        columns = [batch.column(c).to_pylist() for c in ("text", "base", "told")]
        for text, base, told in zip(*columns):
            spans = [(s["kind"], s["start"], s["end"]) for s in base]
            degree: dict[str, float] = {}
            for t in told or []:
                degree[t["term"]] = max(degree.get(t["term"], 0.0), t["disclosure"])
            more = [(4, start, end) for term, start, end in _terms(text or "", spans) if term in degree] if degree else []
            spans_out.append(",".join(f"{names[k]}:{s}:{e}" for k, s, e in spans + more))
            pieces, at = [], 0
            for kind, start, end in sorted(spans + more, key=lambda x: (x[1], x[0])):
                if start < at:
                    at = max(at, end)
                    continue
                pieces.append(text[at:start])
                if kind < 4:
                    pieces.append(f"[{names[kind].upper()}]")
                elif degree[text[start:end].lower()] < REMOVE:
                    pieces.append(shape(text[start:end]))
                at = end
            texts.append("".join(pieces) + (text or "")[at:] if spans or more else None)
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(spans_out, pa.string()), pa.array(texts, pa.string())],
            ["row", "spans", "sanitised"])
    return by_slices(batches, make)


def sanitise(docs: DataFrame, limit: float = LIMIT, least: float = GENERALISE) -> DataFrame:
    """doc_id, base spans, all spans as text, and the sanitised text (null where
    nothing was found). Columns used: doc_id, text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "same", F.xxhash64("text"))
    mentions = materialize(docs.select("same", "text").mapInArrow(_mentions, _MENTIONS), "pii-mentions")
    told = materialize(
        disclosing_terms(docs, mentions, limit, least).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-told")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(told.select(F.xxhash64("term").alias("h"))))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = materialize(numbered.mapInArrow(_find(shared), _FOUND), "pii-found")
    by_row = (
        found.select("row", F.explode("terms").alias("term")).join(told, "term").groupBy("row")
        .agg(F.collect_list(F.struct("term", "disclosure")).alias("told")))
    applied = found.where(F.col("text").isNotNull()).join(by_row, "row", "left").select(
        "row", "text", "base", "told").mapInArrow(_apply, "row long, spans string, sanitised string")
    return found.select("row", "doc_id", "base").join(applied, "row", "left").select(
        "doc_id", "base", F.coalesce("spans", F.lit("")).alias("spans"), "sanitised")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest of the base spans, and all spans of all documents."""
    found = sanitise(table(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("base", lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[number_of("base", k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(listed, 256).alias("base_sha256"), "spans")
