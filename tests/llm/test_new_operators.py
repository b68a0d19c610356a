"""Alignment, resampling, WARC, the sharded language model and the row-wise stages: edges and brute force."""

import gzip
import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import alignment, bloom_lm, chat, common, language_id, resampling, secrets, stages, tiling, warc
from marquee.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
PATH_A = tokenizer_path("MARQUEE_TOKENIZER_A", "byte_bpe_50k.json")
PATH_B = tokenizer_path("MARQUEE_TOKENIZER_B", "piece_bpe_32k.model")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and long texts, repeated rows and ids, odd characters, clashing columns."""
    texts = [(1, "The quick brown fox"), (1, "The quick brown fox"), (1, "another text of the same id"), (2, None), (3, ""), (None, "no id here " * 9),
             (4, LONG), (5, "   "), (6, "a\n\n b\t\u00a0c  "), (7, "\u65e5\u672c\u8a9e \u0438 \u0440\u0443\u0441\u0441\u043a\u0438\u0439"), (8, "<|endoftext|> </s> <unk>"),
             (9, "x\u2581y"), (10, "\u00e9t\u00e9 \U0001f600!"), (11, "it's we'll  DON'T 12345"), (12, "\x00 nul"), (13, "same word same word " * 40)]
    return spark.createDataFrame([(i, t, 7, 8, 9, "z") for i, t in texts], "doc_id long, text string, score long, rank long, chunk long, place string")


# Alignment

def aligned(rows):
    """Plain alignment: per (id, text) the columns, and the pair table."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(PATH_A)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    value = {c: i for i, c in enumerate(alignment.byte_letters())}
    links, documents, per = Counter(), Counter(), []
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        bytes_a = [bytes(value[c] for c in a_lib.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(x)[3:5], 16)]) if b_lib.is_byte(x) else b_lib.id_to_piece(x).replace("\u2581", " ").encode() for x in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per.append((i, None))
            continue
        spans = [[(sum(map(len, x[:k])), sum(map(len, x[:k + 1]))) for k in range(len(x))] for x in (bytes_a, bytes_b)] if len(raw) < 2000 else None
        if spans is None:
            spans = []
            for x in (bytes_a, bytes_b):
                ends = np.cumsum([len(t) for t in x]).tolist()
                spans.append(list(zip([0, *ends[:-1]], ends)))
        own, k = [], 0
        for n, (lo, hi) in enumerate(spans[0]):
            while spans[1][k][1] <= lo:
                k += 1
            j = k
            while j < len(b) and spans[1][j][0] < hi:
                own.append((a[n], b[j]))
                j += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, x, y = [], 0, 0
        for cut in cuts:
            one, two = [], []
            while x < len(a) and spans[0][x][1] <= cut:
                one.append(a[x])
                x += 1
            while y < len(b) and spans[1][y][1] <= cut:
                two.append(b[y])
                y += 1
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
        links.update(own)
        documents.update(set(own))
        per.append((i, (len(a), len(b), len(cuts), own, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = defaultdict(int)
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    table = sorted((x, y, documents[x, y], n, n == best[y]) for (x, y), n in links.items())
    out = [(i, 0, 0, 0, 0, 0, 0, "") if v is None else
           (i, v[0], v[1], v[2], len(v[3]), sum(links[p] == best[p[1]] for p in v[3]), sum(links[p] for p in v[3]), v[4]) for i, v in per]
    return out, table


def test_alignment_equals_plain_alignment(spark, odd, monkeypatch):
    for docs in (odd, sf(spark, "documents")):
        got, pairs = alignment.align(docs, PATH_A, PATH_B)
        want, table = aligned([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        assert sorted(map(tuple, pairs.collect())) == table
    zero = {r["doc_id"] for r in alignment.align(odd, PATH_A, PATH_B)[0].where("n_a = 0").collect()}
    assert {2, 3, 9} <= zero and not zero & {1, 4, 6, 7, 8, 10, 11, 13}


def test_alignment_of_nothing(spark, odd):
    docs, pairs = alignment.align(odd.limit(0), PATH_A, PATH_B)
    assert docs.count() == 0 and pairs.count() == 0


@pytest.mark.parametrize("width", [1, 4, 200])
def test_bitmaps_round_trip(width):
    rng = np.random.default_rng(width)
    sets = [np.sort(rng.choice(8 * width, rng.integers(1, 8 * width + 1), replace=False)) for _ in range(40)]
    sizes = np.array([len(x) for x in sets])
    owner, place = alignment.unpack(sizes, alignment.pack(sizes, np.concatenate(sets), width), width)
    assert sorted(zip(owner.tolist(), place.tolist())) == [(i, p) for i, x in enumerate(sets) for p in x.tolist()]


def test_pair_numbers_go_back_to_their_ids():
    pairs = alignment.PairNumbers(50_257, 32_000)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50_257, 5000), rng.integers(0, 32_000, 5000)
    back = pairs.ids(pairs.of(a, b))
    assert (back[0] == a).all() and (back[1] == b).all() and pairs.of(a, b).max() < 1 << pairs.bits


# Resampling

def resampled(rows, target, percent=25, least=20):
    def features(text):
        w = WORDS.findall(lowered(text))
        return len(w), [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    docs = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for i, n, f in docs:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = None if i is None else int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least and r[0] is not None), key=lambda r: (-r[4], r[0], r[1], r[2], r[3]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("head", [(0, 0), (50, 20), (resampling.HEAD_WORDS, resampling.HEAD_PAIRS)])
def test_resampling_equals_brute_force_with_any_head(spark, odd, head):
    target = sf(spark, "benchmark")
    items = [r["text"] for r in target.collect()]
    for docs, percent, least in ((odd, 60, 1), (sf(spark, "documents"), 25, 20)):
        got = resampling.resample(docs, target, percent, least, head_words=head[0], head_pairs=head[1])
        want = resampled([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], items, percent, least)
        assert sorted(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str) == want


def test_resampling_edges(spark, odd):
    nothing = odd.limit(0)
    assert resampling.resample(nothing, sf(spark, "benchmark")).count() == 0
    alone = resampling.resample(odd, nothing.select("text"), percent=50)
    assert alone.count() == 16 and alone.where("rank IS NOT NULL").count() == 1  # half of the two documents with an id and 20 words
    drawn = resampling.drawn(odd, alone)
    assert drawn.columns == [c for c in odd.columns if c != "rank"] + ["rank"] and drawn.count() == 1


def test_head_vocabulary_has_the_frequent_words_exactly(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat " + f"odd{i}") for i in range(60)] + [(99, "y" * 300 + " " + "y" * 300)], "doc_id long, text string")
    head = resampling.fit_head(docs)
    assert head.words == [b"cat", b"mat", b"on", b"sat", b"the"]
    assert head.states.tolist() == [zlib.crc32(w) for w in head.words] and len(head.pair_keys) == 5


# WARC

def pages(spark):
    rows = [(1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (3, "http://a/3", "short"), (4, "http://a/4", "short"), (5, None, None),
            (6, "http://a/\r\nEvil: 1", "\u00e9" * 50), (7, "http://b/7", "\u00e9" * 50), (8, "http://b/8", LONG * 3), (0, "http://b/0", "x" * 200),
            (None, "http://n", "x" * 200), (None, "http://m", "alone " * 30), (9, "http://c/9", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (10, "u", "")]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, tmp_path, compression):
    path = warc.archive_pages(pages(spark).repartition(3), str(tmp_path / "w"), compression=compression, range_bytes="500", file_bytes="3000")
    got = {r["record_id"]: r for r in warc.read_archives(spark, path, partition_bytes="400").collect()}
    text = {1: "x" * 200, 3: "short", 5: "", 8: LONG * 3, 0: "x" * 200}
    assert bytes(got["<urn:page:0>"]["payload"]).decode() == text[0] and got["<urn:page:1>"]["payload"] is None
    assert bytes(got["<urn:page:8>"]["payload"]).decode() == text[8] and bytes(got["<urn:page:5>"]["payload"]) == b""
    assert got["<urn:page:6>"]["target_uri"] == "http://a/%0D%0AEvil: 1" and got["<urn:page:5>"]["target_uri"] is None
    index = sorted((tuple(r) for r in warc.page_index(spark, path).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    html = [(r["page_id"], r["html"] or "") for r in pages(spark).collect()]
    first = {}
    for i, t in html:
        if i is not None and len(t.encode()) >= 100:
            first[t] = min(first.get(t, i), i)
    want = [(i, len(t.encode()), sha(t), "revisit" if first.get(t, i) != i else "response", first[t] if first.get(t, i) != i else None) for i, t in html]
    assert index == sorted(want, key=str)


def test_pushed_filters_read_headers_only(spark, tmp_path, monkeypatch):
    path = warc.archive_pages(pages(spark).coalesce(1), str(tmp_path / "w"), range_bytes="2000")
    archive = warc.read_archives(spark, path)
    assert {r["record_id"] for r in archive.where("record_type = 'revisit' AND target_uri LIKE 'http://a%'").collect()} == {"<urn:page:1>", "<urn:page:2>"}
    assert archive.where("content_length > 5000").count() == 1 and archive.where("refers_to IS NULL AND record_type <> 'response'").count() == 0
    assert archive.where("record_type IN ('revisit', 'metadata') AND payload IS NOT NULL").count() == 0
    assert archive.where("NOT (target_uri LIKE 'http://a%')").count() == archive.where("target_uri IS NOT NULL AND target_uri NOT LIKE 'http://a%'").count()
    # the reader itself: what it decodes, and the ranges it plans
    reader = warc._WarcReader({"path": path})
    assert list(reader.pushFilters([warc.EqualTo(("record_id",), "<urn:page:3>"), warc.EqualTo(("payload",), b"x")])) == [warc.EqualTo(("payload",), b"x")]
    seen = []
    made = warc._Records.__init__
    monkeypatch.setattr(warc._Records, "__init__", lambda self, *a: (made(self, *a), seen.append(self))[0])
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["payload"] for r in rows] == [b"short"] and sum(r.decoded for r in seen) < 200
    whole, some = warc._WarcReader({"path": path, "partition_bytes": "1"}), warc._WarcReader({"path": path, "partition_bytes": "1"})
    list(some.pushFilters([warc.EqualTo(("record_type",), "revisit")]))
    assert len(some.partitions()) < len(whole.partitions())


def test_foreign_archives(spark, tmp_path):
    """Members without a length field, folded headers, chunked bodies, no manifest; a cut file is an error."""
    def record(kind, block, more=b""):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:uuid:1>\r\n" + more + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x=1\r\nde\r\n0\r\n\r\n"
    records = [record(b"warcinfo", b"software: x", b"WARC-Target-URI: http://x/\r\n  folded\r\n"), record(b"response", http, b"Content-Type: application/http\r\n"),
               record(b"resource", b"q" * 100_000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "in/b.warc").write_bytes(b"".join(records))
    got = warc.read_archives(spark, str(tmp_path / "in")).collect()
    assert sorted((r["record_type"], len(r["payload"])) for r in got) == [("resource", 100_000)] * 2 + [("response", 5)] * 2 + [("warcinfo", 11)] * 2
    assert {r["target_uri"] for r in got if r["record_type"] == "warcinfo"} == {"http://x/ folded"}
    assert warc.read_archives(spark, str(tmp_path / "in/a.warc.gz")).where("record_type = 'resource'").count() == 1
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(records[2])[:150])
    with pytest.raises(Exception, match="cut off|no gzip member|Error -"):
        warc.read_archives(spark, str(tmp_path / "cut.warc.gz")).collect()


def test_only_committed_files_are_read(spark, tmp_path):
    path = warc.archive_pages(pages(spark), str(tmp_path / "w"))
    n = warc.read_archives(spark, path).count()
    name = next(f for f in os.listdir(path) if f.endswith(".gz"))
    (tmp_path / "w/part-left-behind.warc.gz").write_bytes((tmp_path / "w" / name).read_bytes())
    assert n == 13 and warc.read_archives(spark, path).count() == 13
    warc.write_archives(warc.page_records(pages(spark)), path, mode="append")
    assert warc.read_archives(spark, path).count() == 26
    warc.write_archives(warc.page_records(pages(spark)), path, mode="overwrite")
    assert warc.read_archives(spark, path).count() == 13
    empty = warc.archive_pages(pages(spark).limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, empty).count() == 0


def test_a_hot_payload_is_joined_apart(spark, tmp_path, monkeypatch):
    rows = [(i, "u", "hot " * 60) for i in range(50, 150)] + [(i, "u", f"pair {i // 2} " * 30) for i in range(150, 190)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(warc, "HOT", 3)
    got = {r["page_id"]: r["refers_to"] for r in warc.page_index(spark, warc.archive_pages(df, str(tmp_path / "w"))).collect()}
    assert got == {i: None if i == 50 else 50 for i in range(50, 150)} | {i: i - 1 if i % 2 else None for i in range(150, 190)}


# Language model

def test_scores_are_near_the_exact_formula_in_both_forms(spark):
    docs = sf(spark, "documents").select("doc_id", "text")
    rows = [(r["doc_id"], [*re.findall(r"[^\x20\x09-\x0D]+", lowered(r["text"])), None]) for r in docs.collect()]
    one, two = Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            one.update(t)
            two.update(zip([None, *t], t))
    n, v, mu = sum(one.values()), len(one), bloom_lm.MU

    def exact(t):
        total = 0.0
        for p, w in zip([None, *t], t):
            c2 = min(two[p, w], one[w], one[p])
            total += math.log10((c2 + mu * (one[w] + 1) / (n + v + 1)) / (one[p] + mu))
        return total

    want = {i: exact(t) for i, t in rows}
    forms = []
    for most in (1 << 30, 0):  # broadcast, shards
        got = {r["doc_id"]: r["score"] for r in bloom_lm.score(docs, bloom_lm.crc_held_out(), broadcast_bytes=most).collect()}
        error = [abs(got[i] - want[i]) / len(t) for i, t in rows]
        assert sum(error) / len(error) < 0.04  # log10 a token, on average; counts are read in powers of two
        forms.append(got)
    assert forms[0] == forms[1]


@pytest.mark.parametrize("n", [300, 20_000, 400_000])
def test_unseen_ngrams_are_rarely_read_as_seen(n):
    rng = np.random.default_rng(n)
    names = np.unique(rng.integers(0, 2**32, n, dtype=np.uint64))
    counts = np.minimum(rng.zipf(1.6, len(names)), 10**6)
    data = bloom_lm.shard_filter(names, counts)
    other = rng.integers(0, 2**32, 50_000, dtype=np.uint64)
    other = other[~np.isin(other, names)]
    zero = np.zeros(len(other), np.int64)
    assert (bloom_lm.probe(data, other, zero, zero + 8 * len(data)) > 0).mean() < 0.02


@pytest.mark.parametrize("shard_bits", [9, 12, 14])
def test_shards_are_asked_by_groups(monkeypatch, shard_bits):
    """Rows and probes follow groups of shards, not chunks times shards (F1: op6 at 6 GB), and the levels are the filter's."""
    rng = np.random.default_rng(shard_bits)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 3000) % 50_000) for _ in range(12)] + [None, "", "w1"]
    table = pa.table({"row": pa.array(range(len(texts))), "text": pa.array(texts)})
    tokens = list(bloom_lm.token_blocks(table.column("text").combine_chunks()))
    key, count = np.unique(np.concatenate([bloom_lm._ngrams(t, v) for _, t, _, v in tokens]), return_counts=True)
    shard, name = bloom_lm._split(key, shard_bits)
    shards = [(s, bloom_lm.shard_filter(name[shard == s], count[shard == s]).tobytes()) for s in np.unique(shard).tolist()][5:]  # some shards are empty
    groups = 1 << bloom_lm._group_bits(shard_bits)
    asked = []
    for i, rows in enumerate([table.slice(0, 5), table.slice(5, 6), table.slice(11)]):
        own = [r for batch in bloom_lm.questions(i, rows, shard_bits) for r in batch.to_pylist()]
        assert len(own) <= 1 + groups
        asked += own
    bits = [{"part": s >> (shard_bits - bloom_lm._group_bits(shard_bits)), "chunk": None, "shard": s, "bits": b} for s, b in shards]
    asked = sorted(asked + bits, key=lambda r: (r["part"], -1 if r["chunk"] is None else r["chunk"]))
    kinds = {"part": pa.int64(), "chunk": pa.int64(), "shard": pa.int32()}
    schema = pa.schema([(c, kinds.get(c, pa.binary())) for c in ("part", "chunk", "shard", "sizes", "names", "bits", "text")])
    probed = []
    monkeypatch.setattr(bloom_lm, "probe", lambda *a, f=bloom_lm.probe: probed.append(len(a[1])) or f(*a))
    told = list(bloom_lm.answers(pa.Table.from_pylist(asked, schema).to_batches(max_chunksize=4000), shard_bits))
    assert len(probed) <= groups + len(asked) // 4000 + 1  # three chunks, one probe
    told = sorted((r for batch in told for r in batch.to_pylist()), key=lambda r: (r["chunk"], r["part"]))
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("levels", pa.binary()), ("text", pa.binary())])
    whole, rows = bloom_lm.CountFilter(shards, shard_bits), []
    for (row,), blocks, levels in bloom_lm._answered(pa.Table.from_pylist(told, schema).to_batches(max_chunksize=700)):
        rows += row.to_pylist()
        for _, t, _, v in blocks:
            own = np.append(bloom_lm._ngrams(t, v), bloom_lm.unigram_key(np.array([bloom_lm.END])))
            assert (levels.counts(own) == whole.counts(own)).all()
    assert rows == list(range(len(texts)))


def test_odd_rows_score_the_same_in_both_forms(spark, odd):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for docs in (odd, odd.limit(0), odd.where("text IS NULL")):
        forms = [Counter(tuple(r) for r in bloom_lm.score(docs, F.col("doc_id") % 3 == 0, broadcast_bytes=most).select(columns).collect()) for most in (1 << 30, -1)]
        assert forms[0] == forms[1] and sum(forms[0].values()) == docs.count()


def test_chunks_hold_all_rows_in_order_across_batches():
    texts = ["a" * n for n in (10, 0, 95, 5, 300, 1, 99, 100)] + [None, "b" * 101, None, ""]
    table = pa.table({"row": pa.array(range(len(texts))), "text": pa.array(texts)})
    for size in (1, 3, 100):
        chunks = list(bloom_lm.chunks_of(table.to_batches(max_chunksize=size), 100))
        assert [r for c in chunks for r in c.column("row").to_pylist()] == list(range(len(texts)))
        assert all(c.num_rows == 1 or sum(len(t or "") for t in c.column("text").to_pylist()) <= 100 for c in chunks)
        assert [c.num_rows for c in chunks] == [2, 2, 1, 2, 2, 1, 2]
    assert list(bloom_lm.chunks_of([])) == []


# Chat

def test_a_repeated_message_counts_once(spark):
    rows = [(1, None, 10, "user", "hi", 1.0), (1, None, 10, "user", "hi", 1.0), (2, 1, 10, "assistant", "b", 5.0), (2, 1, 10, "assistant", "a", 9.0),
            (3, 1, 10, "assistant", "c", 6.0), (None, 1, 10, "user", "no id", 99.0), (4, None, 11, None, None, None), (5, 4, 11, "x", LONG, 0.0)]
    schema = "node long, parent long, conv_id long, role string, text string, score double"
    got = {r["conv_id"]: r["formatted"] for r in chat.conversations(spark.createDataFrame(rows, schema)).collect()}
    # of node 2 the row with text "a" stands (9 points), once: its branch beats node 3's
    assert chat.read_turns(got[10]) == [("user", "hi"), ("assistant", "a")]
    assert chat.read_turns(got[11]) == [("", ""), ("x", LONG)]
    once = {r["conv_id"]: r["formatted"] for r in chat.conversations(spark.createDataFrame([r for r in rows if r[4] != "b"][1:], schema)).collect()}
    assert once == got and chat.conversations(spark.createDataFrame([], schema)).count() == 0


def test_long_and_repeated_turns_round_trip(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", "\\### </turn> " * 50), (1, 1, "assistant", "\\### </turn> " * 50), (2, 0, None, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, node long, rank long")
    got = {r["conv_id"]: chat.read_turns(r["formatted"]) for r in chat.conversations(chat.chains(df)).collect()}
    assert got == {1: [(r[2], r[3]) for r in rows[:3]], 2: [("", "")]}


# Plain versions of the scans

def test_license_phrases_equal_a_plain_search(spark):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    got = {r["doc_id"]: r for r in QUERIES["op1_licenses"](spark, SF).collect()}
    docs = sf(spark, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        w, r = WORDS.findall(lowered(d["text"])), got[d["doc_id"]]
        places = sorted((i, i + len(p.split()), label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        starts = [i for i, _, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def plain_tiles(a, b, least):
    """Greedy string tiling without hashes."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        longest, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
                    k += 1
                if k > longest:
                    longest, found = k, [(i, j)]
                elif k == longest and k >= least:
                    found.append((i, j))
        if not found:
            return out
        for i, j in found:
            if all(free_a[i:i + longest]) and all(free_b[j:j + longest]):
                for k in range(longest):
                    free_a[i + k] = free_b[j + k] = False
                out.append((i, j, longest))


def test_leaks_equal_plain_tiling(spark):
    items = [(r["item_id"], WORDS.findall(lowered(r["text"]))) for r in sf(spark, "benchmark").collect()]
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.permutation(list("abcdefghijklmnop")).tolist()) for _ in range(10)]
    for i, w in items[:12]:
        cut = len(w) // 2
        texts += [" ".join(w[cut:] + ["between"] + w[:cut]), " ".join(w[: len(w) * 7 // 10]), "x " + " ".join(w).upper() + " y", " ".join(x for k, x in enumerate(w) if k % 7)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, item_id long")
    got = {(r["doc_id"], r["item_id"]): (r["item_words"], r["covered_words"], r["n_tiles"]) for r in tiling.contaminated(docs, sf(spark, "benchmark")).collect()}
    want = {}
    for d, t in enumerate(texts):
        a = WORDS.findall(lowered(t))
        for i, b in items:
            if len(set(a) & set(b)) >= 0.5 * len(set(b)):
                found = plain_tiles(a, b, min(tiling.MIN_MATCH, len(b)))
                covered = sum(n for _, _, n in found)
                if b and covered >= tiling.COVERAGE * len(b) - 1e-9:
                    want[d, i] = (len(b), covered, len(found))
    assert got == want and len(want) >= 20


def test_fused_language_is_the_formula(spark):
    """Priors and declared languages are counted again from the text model's own scores, row by row."""
    import pyarrow as pa

    docs = sf(spark, "documents")
    model = language_id.TextModel.fit(docs)
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    ll, letters = model.score(pa.array([r["text"] for r in rows]))
    best = ll.argmax(1)
    n, read = len(model.languages), letters > 0
    world = np.bincount(best[read], minlength=n) + 1.0
    world /= world.sum()

    def shares(key):
        out = defaultdict(lambda: np.zeros(n))
        for r, b, ok in zip(rows, best, read):
            if ok and r[key] is not None:
                out[r[key]][b] += 1
        return out

    host, said = shares("source"), shares("lang")
    total = sum(said.values(), np.zeros(n)) + len(said) + 1
    got = {r["doc_id"]: r for r in language_id.identify(docs, model, ["doc_id"]).collect()}
    k = language_id.PRIOR_STRENGTH
    for r, scores, count in zip(rows, ll, letters):
        if not count:
            assert got[r["doc_id"]]["language"] == language_id.UNKNOWN
            continue
        prior = (host[r["source"]] + k * world) / (host[r["source"]].sum() + k) if r["source"] is not None and r["source"] in host else world
        lp = scores * language_id.TEXT_WEIGHT + np.log(prior) + (np.log((said[r["lang"]] + 1) / total) if r["lang"] is not None and r["lang"] in said else 0)
        p = np.exp(lp - lp.max())
        assert got[r["doc_id"]]["language"] == model.languages[int(lp.argmax())]
        assert got[r["doc_id"]]["posterior"] == pytest.approx(p.max() / p.sum(), rel=1e-9)


# Secrets

def planted(seed, n):
    """(text, value, whether it is a secret) of lines as they stand in code, settings and prose."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, k: "".join(rng.choice(list(letters), k).tolist())
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    key = low + low.upper() + digits
    word = lambda: str(rng.choice("report system value number letter season market window garden summer letter matter".split()))
    out = []
    for _ in range(n):
        k32, hexed = pick(key, 32) + "7aZ", pick("0123456789abcdef", 40)
        out += [
            (f'api_key = "{k32}"', k32, 1), (f"export DB_PASSWORD=Xy9{pick(key, 14)}", None, 1), (f'"client_secret": "{hexed}",', hexed, 1),
            (f"aws AKIA{pick(low.upper() + digits, 16)} used", None, 1), (f"token: ghp_{pick(key, 36)}", None, 1),
            (f"The password: reset{rng.integers(9)} link was sent to every {word()}.", None, 0),
            (f"token = get_token_from_env(name{rng.integers(9)}, Default{rng.integers(9)})", None, 0),
            (f"auth_token = load_{word()}_token({word()})", None, 0), (f"sha256: {hexed}", hexed, 0), (f"commit {hexed} of the {word()}", hexed, 0),
            (f"uuid 9{pick(digits, 7)}-{pick(digits, 4)}-4{pick(digits, 3)}-a{pick(digits, 3)}-{pick(digits, 12)}", None, 0),
            (f"order {pick(digits, 16)} was sent", None, 0), (f'password = "your_password_{rng.integers(99)}"', None, 0),
            (f"see the {word()}-{word()}-{word()}-{rng.integers(1999, 2030)}-{word()} page", None, 0)]
    return [(t, v, y) for t, v, y in out]


def flagged(spark, lines, **more):
    docs = spark.createDataFrame([(i, "the letter of the market and the window " + t, None) for i, (t, _, _) in enumerate(lines)],
                                 "doc_id long, text string, source string")
    return docs, {r["doc_id"] for r in secrets.scan(docs, **more).collect()}


def test_prose_and_calls_are_no_secrets(spark):
    lines = planted(1, 20)
    _, got = flagged(spark, lines)
    wrong = [lines[i][0] for i in range(len(lines)) if (i in got) != bool(lines[i][2])]
    hits = sum(i in got for i, x in enumerate(lines) if x[2])
    assert hits >= 0.95 * sum(x[2] for x in lines), wrong
    assert not any(i in got for i, x in enumerate(lines) if "reset" in x[0] or "_token(" in x[0] or "get_token" in x[0]), wrong
    assert hits >= 0.95 * len(got), wrong


def test_a_forest_from_labelled_findings_holds_out(spark):
    """Trained on labelled lines of one kind of text, measured on others: precision and recall of 0.9 or more."""
    train, test = planted(2, 25), planted(3, 25)
    docs, _ = flagged(spark, train)
    found = secrets.candidates(docs)
    truth = spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(train)], "doc_id long, label int")
    _, got = flagged(spark, test, labelled=found.join(truth, "doc_id"))
    right = sum(1 for i in got if test[i][2])
    assert right >= 0.9 * len(got) and right >= 0.9 * sum(y for _, _, y in test)


def test_the_scan_stays_on_the_jvm(spark):
    docs, _ = flagged(spark, planted(4, 3))
    for df in (secrets.scan(docs), secrets.word_counts(docs), secrets.described(docs, secrets.candidates(docs))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_dictionary_and_trigrams_are_the_corpus_own(spark):
    docs = spark.createDataFrame([("common common rare",), ("common Common x9y",), (None,)], "text string")
    words = {r["word"]: r["n"] for r in secrets.word_counts(docs).collect()}
    assert words == {"common": 4, "rare": 1}
    assert [r["word"] for r in secrets.dictionary(secrets.word_counts(docs), 1).collect()] == ["common"]
    p = {r["gram"]: r["p"] for r in secrets.trigram_table(secrets.word_counts(docs)).collect()}
    total, kinds = 4 * 6 + 4, 6 + 4
    assert len(p) == kinds and p["^co"] == pytest.approx(math.log(5 / (total + kinds + 1))) and p["re$"] == pytest.approx(math.log(2 / (total + kinds + 1)))


# Stages

def test_rows_that_share_an_id_are_documents_of_their_own(spark, tmp_path):
    a = "alpha beta gamma delta epsilon zeta eta theta"
    b, c = "one two three four five six seven eight nine", "completely different words stand in this third text here"
    rows = [(1, a), (5, a), (5, b), (7, c), (7, b + " " + c), (None, a), (9, None), (9, "")]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = [(r["doc_id"], r["text"]) for r in stages.drop_near_duplicates(spark, docs, SF).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (5, b), (7, c), (7, b + " " + c), (9, None), (9, "")], key=str)
    item = max((r["text"] for r in sf(spark, "benchmark").collect()), key=len)
    more = docs.select("*").limit(0).unionByName(spark.createDataFrame([(1, item, "en", "s", 1), (1, a, "en", "s", 1)], docs.schema))
    more.write.parquet(str(tmp_path / "leaks"))
    left = stages.drop_contaminated(spark, spark.read.parquet(str(tmp_path / "leaks")), SF).collect()
    assert [r["text"] for r in left] == [a]


def test_a_scope_removes_its_tables_and_keeps_the_outer_ones(spark, tmp_path):
    with common.scope(spark):
        inner = common.written(spark.range(3).toDF("x"), "scope-inner")
        outer = common.written(spark.range(4).toDF("x"), "scope-outer", outer=True)
        path = inner.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path) and outer.count() == 4


def test_batches_are_bounded_in_bytes(spark):
    import pyarrow as pa

    common.bounded_batches(spark)
    sizes = spark.range(9000).selectExpr("repeat('x', 2000) AS t").coalesce(1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").collect()
    assert len(sizes) >= 4 and max(r["n"] for r in sizes) < 1.2 * common.BATCH_BYTES


def test_marks_pass_every_marked_row(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 10 = 9 THEN NULL ELSE id END AS k", "id AS v")
    ids = spark.range(0, 1000, 3).toDF("k")
    near, far = common.marked(df, "k", common.marks_of(ids))
    wanted = {r["v"] for r in df.join(ids, "k", "left_semi").collect()}
    got = {r["v"] for r in near.collect()}
    assert wanted <= got and len(got) < len(wanted) + 5 and near.count() + far.count() == 1000
    assert common.without(df, "k", ids).count() == 1000 - len(wanted)
    tree = common.without(df, "k", ids)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("LeftOuter") < tree.index("getbit")  # the marks stand before the join


@pytest.mark.parametrize("name", ["op11_alignment", "op12_resampling", "op13_warc"])
def test_registered_queries_return_every_row(spark, name):
    table = "pages" if name == "op13_warc" else "documents"
    df = QUERIES[name](spark, SF)
    key = df.columns[0]
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in sf(spark, table).select(key).collect())
