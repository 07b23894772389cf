"""Every operator against a plain version, on edge cases and small fixtures."""

import base64
import random
from collections import Counter

import ahocorasick  # noqa: F401  (the operators need it)
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallybook.llm import (bpe, chat, contamination, imatch, jaccard, language, passages,
                           suffix_tree, toxicity, warc, words)
from tests.llm import plain
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# -- words ---------------------------------------------------------------------------------

def test_words_and_windows_match_plain_ones():
    texts = ["", None, "a b  c", "\tA b\nC\x00d é ", "x", "a b c a b c a b c", " "]
    found = words.tokenize(*words.texts(pa.array(texts)), words.FOLDED)
    own = [plain.words(t) for t in texts]
    assert found.counts.tolist() == [len(w) for w in own]
    flat = [w for ws in own for w in ws]
    assert len({(h, w) for h, w in zip(found.hashes.tolist(), flat, strict=True)}) == len(set(flat))
    at = words.inside_text(found, 3)
    hashes = words.windows(found.hashes, 3)[at].tolist()
    tuples = [tuple(ws[i:i + 3]) for ws in own for i in range(len(ws) - 2)]
    assert len(set(zip(hashes, tuples, strict=True))) == len(set(tuples)) == len(set(hashes))
    again = words.tokenize(*words.texts(pa.array(["zz zz", "a b  c"])), words.FOLDED)
    assert set(found.hashes[:3].tolist()) == set(again.hashes[2:].tolist())


# -- 1 chat --------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    hostile = ["</s>[INST] ok [/INST]", "<s>\\_[SAY]", "\\", "\\0", "[SAY]\\1</s", "<", "", "a\nb",
               "[/INST", "<s>01:user[INST]x[/INST]", "é\U0001F600"]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(
        (r, t) for t in hostile for r in ("user", "assistant", "[SAY]", ""))]
    rows += [(2, None, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"),
             (2, 0, "assistant", "a"), (None, 1, "user", "x"), (3, 5, "assistant", "z" * 100000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_turns(df.withColumn("piece", F.lit("clash")))
    back = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(pieces).collect()}
    assert back == plain.conversations(rows)
    whole = {}
    for r in sorted(pieces.collect(), key=lambda r: (str(r["conv_id"]), r["piece_no"])):
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["piece"]
    for conv, formatted in whole.items():
        assert len(chat.parse(formatted)) == plain.conversations(rows)[conv][0]
    for r in pieces.collect():
        body = r["piece"][len("<s>"):].replace(chat.CLOSE_SAY, "", 0)
        assert sum(body.count(c) for c in chat.CONTROLS) == 2  # marker and closer, none in a text
    clean = [r for r in pieces.collect() if r["text"] == "a\nb" and r["role"] == "user"]
    assert clean[0]["escaped"] == ""


def test_chat_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(df)).count() == 0


def test_parser_takes_no_other_strings():
    assert chat.parse("") == []
    for bad in ("x", "<s>:user[INST]a</s>", "<s>:user[SAY]a</s>", "<s>9:user[INST]a[/INST]",
                "<s>0:user[INST]\\1[/INST]", "<s>:user[INST]a[/INST]x", "<s>user[INST]a[/INST]"):
        assert chat.parse(bad) is None


# -- 2 suffix tree -------------------------------------------------------------------------

def test_suffix_tree_counts(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("learn", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    got = pairs(suffix_tree.score(docs, "learn"), "doc_id", "n_tokens", "n_known", "train_tokens",
                F.round("base_score", 6))
    rows = pairs(docs, "doc_id", "text", "learn")
    want = plain.unigrams([r[:2] for r in rows], [r[2] for r in rows])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert suffix_tree.score(no_docs.withColumn("learn", F.lit(True)), "learn").count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "ab c"), (2, None)], "doc_id long, text string")
    got = dict(pairs(suffix_tree.score(docs.withColumn("learn", F.lit(False)), "learn"),
                     "doc_id", "score"))
    assert got == pytest.approx({1: -5 * np.log10(256), 2: -np.log10(256)})


def test_suffix_tree_probabilities():
    texts = [prose(k % 5, 200) for k in range(40)] + ["", "a"]
    data, offsets = words.texts(pa.array(texts))
    found = words.tokenize(data, offsets, words.FOLDED)
    codes = suffix_tree.symbols(data, offsets, found)
    joined = [b" ".join(plain.words(t)) + b"\n" for t in texts]
    assert np.diff(codes.first).tolist() == [len(j) for j in joined]
    assert (codes.codes & np.uint64(255)).astype(np.uint8).tobytes() == b"".join(joined)
    key, count = words.counted(codes.codes)
    levels = suffix_tree.grown(key, count, 4)
    pair, n = levels[0].pairs, levels[0].counts
    low = []
    for _ in range(2):
        pair, n = suffix_tree._summed(suffix_tree._shorter(pair), n)
        low.insert(0, suffix_tree._level(pair, n, None, 0))
    tree = suffix_tree.Tree([*low, *levels])
    for context in codes.codes[::997]:  # the next symbols' probabilities add up to one
        every = (context & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert (10 ** tree.log10(every)).sum() == pytest.approx(1)
    scorer = suffix_tree.Scorer(tree)
    once, twice = scorer.score(codes), scorer.score(codes)
    direct = tree.log10(codes.codes)
    want = [direct[a:b].sum() for a, b in zip(codes.first[:-1], codes.first[1:], strict=True)]
    assert once == pytest.approx(want) and twice == pytest.approx(want)


def test_suffix_tree_keeps_states_by_count_alone(spark, monkeypatch):
    """Scores are those of one tree over all contexts that occur ``LEAST_COUNT`` times, whatever
    share of the corpus that is."""
    monkeypatch.setattr(suffix_tree, "LEAST_SHARE", 1e-2, raising=False)
    texts = [prose(k % 7, 150) for k in range(60)] + [None, "a", "zz " + prose(3, 20)]
    rows = [(k, t, k % 5 != 0) for k, t in enumerate(texts)]

    def codes_of(some):
        data, offsets = words.texts(pa.array([t or "" for t in some]))
        return suffix_tree.symbols(data, offsets, words.tokenize(data, offsets, words.FOLDED))

    levels = suffix_tree.grown(*words.counted(codes_of([t for _, t, x in rows if x]).codes),
                               suffix_tree.LEAST_COUNT)
    pair, n = levels[0].pairs, levels[0].counts
    for _ in range(2):
        pair, n = suffix_tree._summed(suffix_tree._shorter(pair), n)
        levels.insert(0, suffix_tree._level(pair, n, None, 0))
    assert all(len(x.contexts) for x in levels)
    want = suffix_tree.Scorer(suffix_tree.Tree(levels)).score(codes_of(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = dict(pairs(suffix_tree.score(df, "learn"), "doc_id", "score"))
    assert got == pytest.approx(dict(enumerate(want.tolist())))


def test_codes_of_one_ending_are_dealt_out():
    """Contexts that end in the same two symbols are summed and grown in several buckets."""
    data, offsets = words.texts(pa.array([f"{a}{b}he the" for a in "abcdefgh" for b in "ijklmnop"]))
    found = words.tokenize(data, offsets, words.FOLDED)
    codes = words.counted(suffix_tree.symbols(data, offsets, found).codes)[0]
    shift = np.uint64(8 * (suffix_tree.DEPTH - 1))
    some = codes[codes >> shift == ord("h") << 8 | ord("p")]
    assert len(some) == 8
    whole = [len(p) for _, p in suffix_tree._dealt(some, 4)]
    assert sum(whole) == 8 and len(whole) > 1
    roots = suffix_tree._dealt(codes >> np.uint64(8 * (suffix_tree.DEPTH + 1 - suffix_tree._DEALT)),
                               16)
    ends = [b for b, p in roots if (codes[p] >> shift == ord("e") << 8 | ord("h")).any()]
    assert len(ends) > 1


def test_suffix_tree_beats_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    got = suffix_tree.score(docs.withColumn("learn", ~held), "learn").filter("not learn")
    sums = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


# -- 3 WARC --------------------------------------------------------------------------------

def test_warc(spark):
    random.seed(1)
    noise = "".join(chr(random.randrange(32, 0x3000)) for _ in range(40000))
    rows = [(k, f"http://x/{k % 3}?a=é b", t) for k, t in enumerate(
        ["", None, "a", "a", "b" * 70000, noise, noise, "a", "WARC/1.1\r\n\x1f"])]
    rows += [(8, "u", "a"), (None, None, "a"), (None, "v", "only here"), (20, None, "a"),
             (20, None, "a"), (21, "w", "\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("record_type", F.lit("clash"))
    want = Counter(plain.archive([(r[0], r[2]) for r in rows]))
    manifest = warc.write(df, f"{spark.conf.get('spark.checkpoint.dir')}/warc-test")
    for split in (100, 1000, 1 << 22):
        got = Counter(pairs(warc.read(manifest, split), "record_id", "payload_bytes",
                            "payload_digest", "record_type", "refers_to"))
        assert got == want
    texts = {r["record_id"]: r["payload"] for r in warc.read(manifest, 777).collect()
             if r["payload"] is not None}
    assert texts[6].decode() == noise and texts[1] == b""
    assert warc.archive(df.limit(0)).count() == 0


def test_warc_reader_is_not_misled_by_stored_magic():
    """A gzip member inside a payload that is stored uncompressed starts no record."""
    import zlib
    inner = warc.member(b"not a record") * 3

    def stored(data):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()

    bodies = [inner, b"x", inner * 20, b""]
    made = [stored(warc.record("response", k, None, None, warc.digest(b), len(b), b))
            for k, b in enumerate(bodies)]
    archive = b"".join(made)

    class Source:
        def read_at(self, n, at):
            return archive[at:at + n]

    for step in (7, 50, 333, len(archive)):
        found = [r["record_id"] for a in range(0, len(archive), step) for r in
                 warc.records_in(Source(), len(archive), a, min(a + step, len(archive)))]
        assert found == [0, 1, 2, 3]


# -- 4 byte-level BPE ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def test_bpe_agrees_with_the_library(spark, odd_docs, no_docs, vocabulary):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks=vocabulary.ranks, special_tokens={})
    docs = odd_docs.select("doc_id", "text", "token_ids").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select(
            "doc_id", "text", F.lit(1).alias("token_ids")))
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == library.encode_ordinary(
            r["text"] or "")
        assert r["n_tokens"] == len(r["token_ids"]) // 4
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(no_docs, vocabulary).count() == 0


def test_perfect_hash_is_minimal(vocabulary):
    table = vocabulary.table
    assert sorted(s[1] for s in table.slots) == sorted(vocabulary.ranks.values())
    assert all(table.get(k) == v for k, v in vocabulary.ranks.items())
    assert table.get(b"\xff\xfe not there") is None and bpe.perfect_hash({}).get(b"a") is None


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(vocabulary)
    first = [encoder.encode(prose(3, 100)) for _ in range(3)]
    assert len(set(first)) == 1 and len(encoder.memory) <= 10


# -- 5 language ----------------------------------------------------------------------------

def test_language(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.filter(~held))
    found = language.predict(docs.filter(held), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    odd = {r["doc_id"]: r for r in language.predict(odd_docs, model).collect()}
    for k in (1, 2, 3, 14):
        assert (odd[k]["lang_pred"], odd[k]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert language.predict(no_docs, model).count() == 0
    empty = language.fit(no_docs)
    assert {r["lang_pred"] for r in language.predict(odd_docs, empty).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'fr'"))
    assert {r["lang_pred"] for r in language.predict(odd_docs, one).collect()} == {"fr", "und"}


@pytest.mark.parametrize("count", [1, 2, 3, 4, 6, 7, 20, 100])
def test_codewords_differ(count):
    codes = language.codewords(count)
    assert len({tuple(c) for c in codes}) == count
    if count > 2:
        assert min((a != b).sum() for i, a in enumerate(codes) for b in codes[:i]) >= 2


# -- 6 substring dedup ---------------------------------------------------------------------

@pytest.mark.parametrize("size", [50, 7])
def test_repeats(spark, odd_docs, no_docs, size):
    got = pairs(passages.remove_repeats(odd_docs, size=size), "doc_id", "n_words", "n_removed",
                F.sha2("kept_text", 256))
    assert Counter(got) == Counter(plain.repeats(pairs(odd_docs, "doc_id", "text"), size))
    assert passages.remove_repeats(no_docs).count() == 0


def test_repeats_of_few_different_words(spark):
    """Many equal hashes, many equal windows, windows across all kinds of overlap."""
    random.seed(2)
    docs = [(k, " ".join(random.choice("ab") for _ in range(random.randrange(0, 60))))
            for k in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = pairs(passages.remove_repeats(df, size=6), "doc_id", "n_words", "n_removed",
                F.sha2("kept_text", 256))
    assert Counter(got) == Counter(plain.repeats(docs, 6))


def test_removed_spans_are_the_removed_words(spark, odd_docs):
    for r in passages.remove_repeats(odd_docs).collect():
        found = plain.words(r["text"], lower=False)
        for span in reversed(r["removed"]):
            del found[span["start"]:span["end"]]
        assert b" ".join(found).decode() == r["kept_text"]


# -- 7 decontamination ---------------------------------------------------------------------

ITEMS = [(10, prose(20, 25)), (9, prose(21, 4)), (11, ""), (12, None), (13, "?!"),
         (14, prose(20, 25)), (10, "Zebra"), (None, prose(22, 12)), (15, prose(21, 30))]


@pytest.mark.parametrize("limit", [1 << 20, 100])
def test_contamination(spark, odd_docs, no_docs, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    more = spark.createDataFrame([
        (100, "x " + prose(20, 25).upper() + " y"), (101, prose(20, 9)), (102, "a zebra, zebra!"),
        (103, prose(22, 12)), (104, prose(21, 4) + "-" + prose(21, 30)),
        (105, "é" + prose(20, 25).replace(" ", " -- "))], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text", F.lit("c").alias("Items")).unionByName(
        more.withColumn("Items", F.lit("c")))
    found = contamination.scan(docs, items, automaton_bytes=limit)
    got = pairs(found, "doc_id", "n_words", contamination.hit_words(), F.size("items"),
                F.sha2(F.array_join("items", ","), 256), F.size("word_spans") > 0)
    assert Counter(got) == Counter(plain.contamination(pairs(docs, "doc_id", "text"), ITEMS))
    by_id = {r["doc_id"]: r for r in found.collect() if r["doc_id"] and r["doc_id"] >= 100}
    spans = by_id[102]["char_spans"]
    assert [by_id[102]["text"][s["start"]:s["end"]].lower() for s in spans] in (
        ["zebra, zebra"], ["zebra", "zebra"])
    assert contamination.scan(no_docs, items).count() == 0
    assert {r["n_words"] for r in contamination.scan(
        docs, items.limit(0)).filter("size(word_spans) > 0").collect()} == set()
    cut = {r["doc_id"]: r["text"] for r in contamination.without_hits(found).collect()}
    assert cut[100] == "x  y" and cut[101] == prose(20, 9)


# -- 8 fingerprints ------------------------------------------------------------------------

def test_fingerprints(spark, odd_docs, no_docs):
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    rows = sorted(pairs(docs, "doc_id", "text"))
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(docs).collect()}
    prints = {}
    for k, (d, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        assert got[d]["n_chars"] == len(text)
        assert got[d]["edited_sha256"] == plain.sha(edited.encode())
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
        assert prints.setdefault(text, got[d]["fingerprint"]) == got[d]["fingerprint"]
        if edited == text:
            assert got[d]["near_edited"] == 1.0
        assert (got[d]["near_edited"] == 1.0) == (
            got[d]["fingerprint"] == got[d]["edited_fingerprint"])
    assert imatch.edited_fingerprints(no_docs.select("doc_id", "text")).count() == 0


def test_next_document_over_many_ranges(spark):
    ids = [3 * k for k in range(500)] + [3 * 7] * 5
    docs = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)],
                                 "doc_id long, text string").repartition(40)
    rows = imatch.in_order(docs).filter("not guest").collect()
    order = sorted((r["doc_id"], r["text"]) for r in rows)
    assert len(rows) == len(ids)
    want = {a: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert {(r["doc_id"], r["text"]): r["next_text"] for r in rows} == want


def test_fingerprints_tell_edits_from_other_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = imatch.edited_fingerprints(docs).agg(
        F.avg("near_edited"), F.avg("near_next"),
        F.avg((F.col("near_edited") > F.col("near_next")).cast("double"))).first()
    assert r[0] > 5 * r[1] and r[2] > 0.9


# -- 9 toxicity ----------------------------------------------------------------------------

def test_toxicity(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, labels.filter(~held))
    scored = toxicity.score(docs.join(labels, "doc_id").filter(held), model)
    shares = {r["toxic"]: r["p"] for r in scored.groupBy("toxic").agg(
        F.avg((F.col("score") >= 0.3).cast("double")).alias("p")).collect()}
    assert shares[1] > 0.8 and shares[0] < 0.02
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(no_docs, model).count() == 0
    for keep, low, high in (("toxic = 1", 0.9, 1), ("toxic = 0", 0, 0.1), ("false", 0, 0.1)):
        plain_model = toxicity.fit(docs, labels.filter(keep))
        assert all(low <= r["score"] <= high for r in
                   toxicity.score(odd_docs, plain_model).collect())


def test_toxicity_takes_one_row_of_an_id(spark):
    """Rows that share a sampled id change nothing in what is learned, however many they are."""
    rows = [(k, ("vile rotten scum " if k % 2 else "calm kind friend ") + prose(k % 9, 12))
            for k in range(60)]
    schema = "doc_id long, text string"
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    more = [(0, rows[0][1] + f" z{k} vile rotten scum") for k in range(500)]
    once, often = (toxicity.fit(spark.createDataFrame(r, schema), labels)
                   for r in (rows, rows + more))
    assert np.any(once.weights) and often.weights == pytest.approx(once.weights)
    assert often.intercept == pytest.approx(once.intercept)


# -- 10 n-gram Jaccard join ----------------------------------------------------------------

def test_components(spark, odd_docs, no_docs):
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = set(pairs(jaccard.near_duplicates(docs), "doc_id", "n_shingles", "component_id"))
    assert got == plain.components(pairs(docs, "doc_id", "text"))
    every = jaccard.near_duplicates(odd_docs).collect()
    assert len(every) == odd_docs.count()
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_components_of_families(spark, monkeypatch):
    """Exact copies, chains of edits, a common passage, borderline pairs, few words."""
    random.seed(3)
    docs, n = [], 0
    common = prose(400, 30).split()
    for family in range(12):
        base = prose(100 + family, random.randrange(4, 120)).split()
        for _ in range(random.randrange(1, 14)):
            text = list(base)
            for _ in range(random.randrange(0, 5)):
                at = random.randrange(len(text))
                text[at] = random.choice(("alpha", "beta", f"w{random.randrange(50)}"))
            if random.random() < 0.3:
                text += common
            if random.random() < 0.3:
                base = text  # the next ones are edits of an edit
            docs.append((n, " ".join(text)))
            n += 1
    docs += [(n + k, prose(500 + k, 6) + " " + " ".join(common)) for k in range(40)]
    docs += [(n + 100 + k, " ".join(random.choice("ab") for _ in range(8))) for k in range(60)]
    monkeypatch.setattr(jaccard, "MEMBERS", 3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = set(pairs(jaccard.near_duplicates(df), "doc_id", "n_shingles", "component_id"))
    assert got == plain.components(docs)


def test_links_are_all_counted(spark, monkeypatch):
    """Families of different texts that are all alike, exact copies among them, against brute force;
    one family in several chunks."""
    random.seed(5)
    docs = []
    for family, members in ((0, 40), (1, 3), (2, 2), (3, 1)):
        base = prose(700 + family, 150).split()
        for k in range(members):
            text = list(base)
            for _ in range(k % 4):
                text[random.randrange(len(text))] = f"w{k}"
            docs.append((len(docs), " ".join(text)))
    docs += [(len(docs), None), (len(docs) + 1, ""), (None, docs[0][1])]
    sets = [plain.shingles(t) for _, t in docs]
    want = Counter()
    for x, (d, _) in enumerate(docs):
        want[d, sum(1 for y in range(len(docs)) if x != y and sets[x] and 100 * len(
            sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]))] += 1
    assert sum(n for _, n in want) > 10 * len(docs)
    for chunk, columns, sparse in ((1000, 2048, 32), (7, 16, 32), (7, 16, 0)):
        monkeypatch.setattr(jaccard, "CHUNK", chunk)
        monkeypatch.setattr(jaccard, "COLUMNS", columns)
        monkeypatch.setattr(jaccard, "SPARSE", sparse)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        assert Counter(pairs(jaccard.near_duplicates(df), "doc_id", "n_verified")) == want


def test_slots_count_copies_of_long_runs(spark, monkeypatch):
    """A run of 40 members in 8 chunks makes 320 rows, not 40."""
    monkeypatch.setattr(jaccard, "CHUNK", 5)
    runs = spark.createDataFrame([(-1, k, 9, 4) for k in range(40)],
                                 "run long, grp long, cap int, weight int")
    nodes = spark.createDataFrame([(k, k, 9) for k in range(40)], "node long, grp long, size int")
    labels = spark.createDataFrame([], "node long, label long")
    rows, n_rows = jaccard._open(runs, nodes, labels)
    assert (rows.count(), n_rows) == (40, 320)
    monkeypatch.setattr(jaccard, "SLOT_ROWS", 100)
    assert jaccard._slots(n_rows) == 4


def test_ranks_file_is_only_read(vocabulary):
    line = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").readline().split()
    assert vocabulary.ranks[base64.b64decode(line[0])] == int(line[1])
