"""Operators that look at one text at a time, against plain versions."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spendlens.llm import byte_bpe, pii, quality_rules, registry, secrets, token_cache
from spendlens.llm.common import table
from spendlens.sources.store import scratch_path
from tests.compare import connect, difference
from tests.llm import brute


def rows(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def wanted(texts, make):
    return Counter((i, *make(t)) for i, t in texts)


# ---------------------------------------------------------------- personal data

def counted(found):
    kinds = [F.size(F.filter("base", (lambda k: lambda s: s["kind"] == k)(k))).alias(f"n{k}") for k in range(4)]
    return rows(found.select("doc_id", *kinds), "doc_id", "n0", "n1", "n2", "n3")


def test_pii_base(hostile, empty, texts):
    assert counted(pii.sanitise(hostile)) == wanted(texts, lambda t: brute.pii(t)[:4])
    assert pii.sanitise(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_pii_places(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b.c", "@", "1", "22", "255", ".", " ", "-", "+", "(", "_", "é", "4111111111111111"])
                       for _ in range(rng.randint(0, 40)))
        spans = pii.base_spans(text)
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        n = Counter(k for k, _, _ in spans)
        import hashlib
        assert (n[0], n[1], n[2], n[3], hashlib.sha256(told.encode()).hexdigest()) == brute.pii(text), text


def test_pii_of_the_tables(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    got = rows(registry.QUERIES["op1_pii"](spark, folder), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == wanted(docs.items(), brute.pii)


def test_terms_that_tell_an_entity_go(spark):
    filler = ["alpha beta gamma delta", "epsilon beta alpha theta", "gamma delta theta iota", "kappa beta delta alpha"]
    rows_in = [(i, f"{filler[i]} beta zanzibar jane@corp.example.org beta thing {i}") for i in range(4)]
    rows_in += [(10 + i, f"beta alpha gamma delta theta number {i} thing") for i in range(60)]
    found = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows_in, "doc_id long, text string")).collect()}
    assert "zanzibar" not in found[0]["sanitised"] and "[EMAIL]" in found[0]["sanitised"] and "beta" in found[0]["sanitised"]
    assert ",term:" in found[0]["spans"] and found[10]["spans"] == "" and found[10]["sanitised"] is None


def test_terms_of_an_entity_in_one_text_go_and_copies_count_once(spark):
    common = "beta alpha gamma delta theta number thing"
    rows_in = [(0, f"{common} zanzibar jane@corp.example.org thing")]
    # The entity's copies are one text, and so are those of a text with the term alone.
    rows_in += [(100 + i, f"{common} quixote joe@corp.example.org thing") for i in range(50)]
    rows_in += [(200 + i, f"{common} mention of alpha") for i in range(50)]
    rows_in += [(1000 + i, f"{common} {i} here") for i in range(200)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    for i, term in ((0, "zanzibar"), (100, "quixote"), (149, "quixote")):
        assert term not in found[i]["sanitised"] and "gamma delta" in found[i]["sanitised"]
        assert "[xxx] [EMAIL]" in found[i]["sanitised"]
    same = docs.withColumn("same", F.xxhash64("text"))
    pairs = same.selectExpr("same", "case when text like '%@%' then array(named_struct('entity', 1L, 'term', 'gamma'), "
                                    "named_struct('entity', 1L, 'term', if(doc_id = 0, 'zanzibar', 'quixote'))) "
                                    "else array() end as pairs")
    told = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(same, pairs, least=-9.0).collect()}
    for term, both, texts in (("gamma", 2, 203), ("quixote", 1, 1), ("zanzibar", 1, 1)):
        assert told.get(term, 0.0) == pytest.approx(wilson(both, texts) if wilson(both, texts) >= 2 * 2 / 203 else 0.0)


def wilson(both, texts):
    p = both / texts
    return (p + 1 / (2 * texts) - (p * (1 - p) / texts + 1 / (4 * texts * texts)) ** 0.5) / (1 + 1 / texts)


def plain_term_spans(texts):
    """Term spans of every text, by the definition."""
    import re
    bases, pairs, holding, mentions = {}, Counter(), Counter(), Counter()
    for text in set(texts):
        bases[text] = spans = pii.base_spans(text)
        words = [(m.group().lower(), *m.span()) for m in re.finditer(r"[^\W\d_]+", text) if len(m.group()) >= pii.LEAST_CHARS]
        holding.update({w[0] for w in words})
        free = [w for w in words if not any(s < w[2] and w[1] < e for _, s, e in spans)]
        near = set()
        for span in spans:
            name = pii.entity(text, span)
            before, after = [w for w in free if w[1] < span[2]], [w for w in free if w[1] >= span[2]]
            near |= {(name, w[0]) for w in before[-pii.WINDOW:] + after[:pii.WINDOW]}
        pairs.update(near)
        mentions.update({name for name, _ in near})
    told = {term for (name, term), n in pairs.items()
            if wilson(n, holding[term]) >= max(pii.GENERALISE, 2 * mentions[name] / len(bases))}
    return {text: ",".join(f"term:{m.start()}:{m.end()}" for m in re.finditer(r"[^\W\d_]+", text)
                           if m.group().lower() in told and not any(s < m.end() and m.start() < e for _, s, e in spans))
            for text, spans in bases.items()}


def test_term_spans_of_the_tables(spark, folder):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, folder, "documents").collect()}
    want = plain_term_spans(list(docs.values()))
    got = {r["doc_id"]: ",".join(x for x in r["spans"].split(",") if x.startswith("term"))
           for r in registry.QUERIES["op1_pii"](spark, folder).collect()}
    assert got == {i: want[text] for i, text in docs.items()} and any(got.values())


@pytest.mark.parametrize("others", [30, 3000])
def test_verdicts_do_not_depend_on_the_size_of_the_corpus(spark, others):
    rows = [(i, f"zanzibar with jane@corp.example.org number {i} quixote{'' if i else ' once'}") for i in range(5)]
    rows += [(10, "once joe@corp.example.org alone"), (11, "here is quixote")]
    rows += [(100 + i, f"number with alone here text {i}") for i in range(others)]
    found = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # Five texts of five are enough to remove a term, five of six to generalise it, one of two are not.
    assert found[0] == " with [EMAIL] number 0 [xxx] once" and found[11] == "here is [xxx]"
    assert found[10] == "once [EMAIL] alone" and found[100] is None


def test_shapes():
    assert [pii.shape(t) for t in ("Zanzibar", "USA", "McDonald", "ab")] == ["[Xxxx]", "[XXX]", "[XxXxxx]", "[xx]"]


def test_terms_go_where_the_entity_is_not_and_far_from_it(spark):
    common = "beta alpha gamma delta theta number thing"
    rows_in = [(i, f"{common} {i} zanzibar jane@corp.example.org {common} {common} {common} Zanzibar end") for i in range(8)]
    rows_in += [(50, f"{common} in ZANZIBAR then"), (51, f"{common} zanzibars"), (52, None)]
    rows_in += [(100 + i, f"{common} {i} here") for i in range(400)]
    found = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows_in, "doc_id long, text string")).collect()}
    assert found[50]["sanitised"] == f"{common} in [XXX] then" and found[50]["base"] == []
    assert found[50]["spans"] == f"term:{len(common) + 4}:{len(common) + 12}"
    assert found[3]["spans"].count(",term:") == 2 and "anzibar" not in found[3]["sanitised"]
    assert all(found[i]["spans"] == "" and found[i]["sanitised"] is None for i in (51, 52, 100, 499))


# ---------------------------------------------------------------- token counts

def test_token_counts_and_cache(spark, hostile, empty, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def plain(text):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        return len((text or "").encode()), n, n > 1024

    cache = scratch_path(spark, "cache")
    first = token_cache.count_tokens(hostile.where("doc_id < 10"), cache)
    assert rows(first, "doc_id", "n_bytes", "n_tokens", "over_limit") == wanted(
        [x for x in texts if x[0] is not None and x[0] < 10], plain)
    few = spark.read.parquet(cache).count()
    assert few == len({t or "" for i, t in texts if i is not None and i < 10})
    every = token_cache.count_tokens(hostile, cache)
    assert rows(every, "doc_id", "n_bytes", "n_tokens", "over_limit") == wanted(texts, plain)
    # Each distinct text is stored once, whichever run found it.
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in texts})
    assert token_cache.count_tokens(empty, scratch_path(spark, "cache")).count() == 0


def test_a_digest_stored_twice_does_not_repeat_documents(spark, hostile, texts):
    cache = scratch_path(spark, "cache")
    once = token_cache.count_tokens(hostile, cache).collect()
    spark.read.parquet(cache).limit(5).write.mode("append").parquet(cache)
    assert Counter(token_cache.count_tokens(hostile, cache).collect()) == Counter(once) and len(once) == len(texts)


def test_contract_columns_come_first(spark, folder):
    first = {"op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
             "op9_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
             "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
             "op11_line_dedup": "doc_id n_lines n_dropped kept_sha256",
             "op12_collocations": "lang rank phrase a l r n score",
             "op13_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"}
    for name, columns in first.items():
        assert registry.QUERIES[name](spark, folder).columns[:len(columns.split())] == columns.split()


# ---------------------------------------------------------------- quality rules

def test_rules(hostile, empty, texts):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = quality_rules.apply_rules(hostile)
    assert rows(found, "doc_id", *names) == wanted(texts, brute.rules)
    assert found.where("kept and base_failed").count() == 0
    assert quality_rules.apply_rules(empty).count() == 0


def test_rules_on_random_texts(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice(["a", "b", "c", " ", " ", "\n", "\t", "#", "é", "a b c "]) for _ in range(rng.randint(0, 90))))
             for i in range(500)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(quality_rules.measures(df), "doc_id", *names[:5]) == wanted(texts, lambda t: brute.rules(t)[:5])


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, folder, name):
    report, n, _, _ = difference(spark, connect(folder), folder, registry.QUERIES[name], registry.SQL[name])
    assert not report and n > 0


# ---------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def reference_encoding():
    import tiktoken
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(hostile, empty, texts, reference_encoding):
    found = byte_bpe.encode_decode(hostile, ["ids", "decoded", "round_trip"])
    got = Counter((r["doc_id"], tuple(r["ids"]), r["decoded"], r["round_trip"]) for r in found.collect())
    assert got == Counter((i, tuple(reference_encoding.encode_ordinary(t or "")), t or "", True) for i, t in texts)
    assert byte_bpe.encode_decode(empty, ["n_tokens"]).count() == 0


def test_bpe_digests(spark, folder, reference_encoding):
    import hashlib
    sha = lambda b: hashlib.sha256(b).hexdigest()
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]

    def plain(text):
        ids = reference_encoding.encode_ordinary(text or "")
        return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())

    got = registry.QUERIES["op7_byte_bpe"](spark, folder)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted(docs, plain)


@pytest.mark.parametrize("look,far", [(6, 14), (1, 2), (3, 3)])
def test_bpe_on_random_words(monkeypatch, reference_encoding, look, far):
    monkeypatch.setattr(byte_bpe, "LOOK", look)
    monkeypatch.setattr(byte_bpe, "FAR", far)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    transducer = byte_bpe.Transducer(ranks)
    rng = random.Random(look)
    pieces = ["a", "ab", "e", "th", "ing", "é", "ß", "1", "#", "==", "😀", "aaaa", "\n", " ", "tion"]
    for _ in range(1500):
        word = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))).encode()
        assert transducer.encode(word) == reference_encoding._core_bpe.encode_single_piece(word)


def test_decode_holds_back_unfinished_characters(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 1)
    parts = {"0": "😀".encode()[:1], "1": "😀".encode()[1:3], "2": "😀".encode()[3:], "3": b"x", "4": b"\xc3"}
    assert list(byte_bpe.decode_stream(["0", "1", "2", "3"], parts)) == ["", "", "😀", "x", ""]
    assert "".join(byte_bpe.decode_stream(["3", "4"], parts)) == "x�"


# ---------------------------------------------------------------- secrets

def secret_spans(text):
    return (brute.secrets(text)[4],)


def base_only(found):
    return found.withColumn("base", secrets.listed(F.filter("spans", lambda s: s["kind"] < 3)))


def test_secrets(hostile, empty, texts):
    found = secrets.scan(hostile)
    assert rows(base_only(found), "doc_id", "base") == wanted(texts, secret_spans)
    assert secrets.scan(empty).count() == 0
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[1]["masked"] is None and "deadbeef" not in by_id[8]["masked"] and "[ACCESS]" in by_id[8]["masked"]
    plain = dict(texts)[8]
    spans = [(s["start"], s["end"]) for s in by_id[8]["spans"]]
    assert all(0 <= a < b <= len(plain) for a, b in spans)


def test_secrets_on_random_texts(spark):
    rng = random.Random(3)
    pieces = ["password", "Token", "api_key", "=", ":", " ", '"', "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "x", "\n", "secret"]
    texts = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))) for i in range(400)]
    found = secrets.scan(spark.createDataFrame(texts, "doc_id long, text string"))
    assert rows(base_only(found), "doc_id", "base") == wanted(texts, secret_spans)


def test_secrets_of_the_tables(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    got = rows(registry.QUERIES["op9_secret_scans"](spark, folder), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == wanted(docs, lambda t: brute.secrets(t)[:4])


def test_random_strings_and_names(spark):
    """The model tells random strings from names with digits, trained on what the patterns found."""
    rng = random.Random(1)
    letters = secrets.ALPHABET[:62]
    random_string = lambda n: "".join(rng.choice(letters) for _ in range(n))
    words = "account customer payment history version release identifier document".split()
    name = lambda: "_".join(rng.choice(words) for _ in range(3)) + str(rng.randint(1, 99))
    docs = [(i, f"token={random_string(30)}") for i in range(200)]
    docs += [(1000 + i, " ".join(name() for _ in range(20))) for i in range(200)]
    docs += [(5000, f"see {random_string(28)}7a here"), (5001, f"see {name()} here")]
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]]
             for r in secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[5000] == [3] and found[5001] == []
    assert sum(bool(found[1000 + i]) for i in range(200)) == 0
