"""The corpus operators against brute force, round trips and held-out accuracy, and on awkward tables."""

from __future__ import annotations

import hashlib
import io
import random
import re
import time
import wave
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import audio_features, ball_tree, bpe, chat_format, common, entries, graph, host_reputation, language_id, linking, near_dedup, packing, passage_dedup, quality
from rosterlake.llm.common import text_slices
from rosterlake.storage import materialize

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, hash string, component string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, very long, equal and repeated rows, and columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
    texts = [None, "", " \n\t ", "***", "a", "One two three.", "One two three.", long, "é ünï " * 40, "x" * 70_000, "same words here again and again " * 30, "same words here again and again " * 30, "\x00\x1f <|endoftext|> <|im_end|>"]
    rows = [(i, t, None if i % 3 == 0 else "en", None, None, 0.5, "h", None) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id", "en", "s", 1, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_slices():
    texts = ["abc", None, "d" * 50, "", "e"]
    assert [x for a, b in text_slices(texts, 10) for x in texts[a:b]] == texts


# ---------------------------------------------------------------- language ID


def test_language_accuracy(spark):
    found = entries.op1_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").df().merge(found, on="doc_id")
    assert ((truth.lang == truth.lang_pred)[truth.held_out]).mean() > 0.97 and found.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(found.doc_id, found.held_out, strict=True))


def test_language_scores_are_naive_bayes(spark, docs):
    model = language_id.fit(docs)
    text = "Le chat ÉTAIT 12 là."
    pieces = re.sub(r"[^\W\d_]+|[\W\d_]+", lambda m: m[0] if m[0].isalpha() else " ", text.lower())
    logs = model.prior.copy()
    for _, _, buckets in language_id.gram_buckets([text]):
        assert buckets.shape[1] in (len(pieces), len(pieces) + 1)
        logs = logs + sum(model.weights[row].astype(float).sum(axis=0) for row in buckets) / language_id.ORDERS
    want = np.exp(logs - logs.max())
    assert abs(model.score([text])[1][0] - want.max() / want.sum()) < 1e-4


def test_language_counts_by_hand(spark):
    """fit() recounted n-gram by n-gram, with the hash spelt out in whole numbers."""
    rows = [(1, "Ab, ab 3 cd", "en"), (2, "xyz xyz", "fr"), (3, "éa", "fr"), (4, "lost", None), (5, None, "en")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mask, primes = (1 << 32) - 1, [int(p) for p in language_id._PRIMES]
    counts = {"en": Counter(), "fr": Counter()}
    for _, text, lang in rows:
        if lang:
            clean = re.sub(r"[^a-zé]+", " ", (text or "").lower())
            clean = clean if clean.endswith(" ") else clean + " "
            for i in range(len(clean)):
                for n in (1, 2, 3):
                    # an n-gram over the end holds what is there
                    h = 0
                    for c in clean[i : i + n]:
                        h = (h * primes[0] + (ord(c) + 1) * primes[1]) & mask
                    h = h * primes[0] ** (n - len(clean[i : i + n])) & mask
                    counts[lang][((h ^ (h >> 15)) * primes[2] & mask) >> (32 - language_id.BITS)] += 1
    for k, lang in enumerate(model.langs):
        want = np.array([counts[lang][b] + language_id.SMOOTHING for b in range(1 << language_id.BITS)])
        assert np.allclose(model.weights[:, k], np.log(want / want.sum()), atol=1e-4)


def test_language_slices_agree(docs, monkeypatch):
    model = language_id.fit(docs)
    text = "Wörter und the words of les mots " * 50
    whole = model.score([text])
    monkeypatch.setattr(language_id, "SLICE_CHARS", 37)
    cut = model.score([text])
    assert whole[0] == cut[0] and abs(whole[1][0] - cut[1][0]) < 1e-6


def test_language_odd(odd, none, docs):
    model = language_id.fit(docs)
    rows = language_id.predict(odd, model).collect()
    assert len(rows) == 15
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (0, 1, 2, 3)} == dict.fromkeys(range(4), "und")
    assert language_id.predict(none, model).count() == 0 and language_id.keep_identified(odd, model, 0.0).columns == odd.columns
    empty = language_id.fit(none)
    assert {r["lang_pred"] for r in language_id.predict(odd, empty).collect()} == {"und"}


def test_unknown_languages_are_rejected(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(2)
    odd = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах, они наделены разумом и совестью",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        *("".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(6 * n)) for n in (20, 50, 100)),
    ]
    more = docs.unionByName(spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string"), allowMissingColumns=True)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, more, "").select("doc_id").collect()}
    clear = {r["doc_id"] for r in language_id.keep_identified(docs, language_id.fit(docs)).select("doc_id").collect()}
    assert kept == clear and len(clear) > 990


# ---------------------------------------------------------------- quality


def test_quality_accuracy(spark):
    found = entries.op9_quality(spark, "/root/testdata/sf0.1").toPandas()
    truth = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.1/labels.parquet'").df().merge(found[found.held_out], on="doc_id")
    assert (truth.quality == truth.predicted).mean() > 0.97 and found.score.between(0, 1).all()


def test_quality_votes(spark, docs):
    """Against cosines of all pairs and a full sort by (steps of) similarity and doc_id."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    texts = [t for t in texts_of(docs).values()][:40]
    raw = np.array([quality.raw_vectors([t])[0] for t in texts], np.float64) * model.scale @ model.basis
    near = raw / np.linalg.norm(raw, axis=1, keepdims=True) @ model.vectors.T.astype(np.float64)
    for text, row in zip(texts, np.rint(near * quality.STEPS) / quality.STEPS, strict=True):
        best = sorted(range(len(row)), key=lambda i: (-row[i], i))[: quality.K]
        weight = np.maximum(row[best], 0) ** 4 + 1e-9
        assert abs(model.score([text])[0] - (weight * model.labels[best]).sum() / weight.sum()) < 0.08


def test_equal_similarities_go_to_the_smaller_id(spark):
    text = "Some plain words, again and again."
    docs = spark.createDataFrame([(i, text) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= quality.K)) for i in range(400)], "doc_id long, quality int")
    assert quality.fit(docs, labels).score([text]).tolist() == [0.0]
    turned = spark.createDataFrame([(i, int(i < quality.K)) for i in range(400)], "doc_id long, quality int")
    model = quality.fit(docs, turned)
    assert model.score([text]).tolist() == [1.0] and len(quality.fit(docs, labels, 50).labels) <= 50
    rng = np.random.default_rng(1)
    near = rng.integers(0, 6, (50, 80)) / 8
    assert all(sorted(r, key=lambda i: (-row[i], i)) == sorted(range(80), key=lambda i: (-row[i], i))[:9] for row, r in zip(near, quality._nearest(near, 9).tolist(), strict=True))


def test_quality_odd(spark, odd, none, docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (7, 1), (99, 1), (None, 1), (8, None)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    rows = {r["doc_id"]: r["score"] for r in quality.predict(odd, model).collect()}
    assert rows[0] == rows[1] == model.share and all(0 <= s <= 1 for s in rows.values())
    assert quality.predict(none, model).count() == 0
    blank = quality.fit(none, labels)
    assert {r["score"] for r in quality.predict(odd, blank).collect()} == {0.5}


# ---------------------------------------------------------------- audio


def test_audio_round_trip(odd, none):
    for r in audio_features.media_digests(odd).collect():
        if r["doc_id"] is None:
            continue
        text = next(x["text"] for x in odd.where(F.col("doc_id") == r["doc_id"]).collect())
        data = (text or "").encode()
        payload = data + b"\xff" * (max(576, -(-len(data) // 576) * 576) - len(data))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        media = audio_features.write_wav(payload)
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        with wave.open(io.BytesIO(media)) as w:
            assert (w.getsampwidth(), w.getnchannels(), w.readframes(w.getnframes())) == (1, 1, payload)
    rows = {r["doc_id"]: r["feature"] for r in audio_features.media_digests(odd).collect()}
    assert rows[5] == rows[6] and rows[10] == rows[11] and rows[0] == rows[1]
    assert audio_features.media_digests(none).count() == 0


def test_audio_resampling_and_segments():
    bank = audio_features.polyphase_filters()
    x = np.random.default_rng(1).normal(size=500).astype(np.float32)
    got, taps = audio_features.resample(x, bank), bank.shape[1]
    padded = np.concatenate([np.zeros(taps // 2), x, np.zeros(taps + 3)])
    want = [padded[k * 3 // 2 : k * 3 // 2 + taps] @ bank[k * 3 % 2] for k in range(len(got))]
    assert len(got) == 334 and np.allclose(got, want, atol=1e-5)
    energy = np.array([-20, -8, -10, -11, -13, -10, -8, -20, -11, -5.0])
    assert audio_features.segments(energy).tolist() == [[1, 4], [6, 7], [9, 10]]
    table = audio_features.read_tensors(audio_features.tensors_ipc(iter([np.ones((70, audio_features.MELS), np.float32)])))
    assert table["log_mel"].combine_chunks().to_numpy_ndarray().shape == (2, audio_features.PATCH, audio_features.MELS)
    assert table["start_s"].to_pylist() == [0.0, 0.64]


def test_audio_blocks_and_brute_force(monkeypatch):
    """Log-mel rows of a whole sound by a plain discrete Fourier transform and triangles in mel, whatever the blocks."""
    text = "Some words, 12 numbers and the like. " * 60
    raw = np.frombuffer(audio_features.payload_of(text)[0], np.uint8)
    whole = np.concatenate([m for m, _ in audio_features.log_mel(raw)])
    signal = audio_features.resample((raw.astype(np.float32) - 128) / 128, audio_features.polyphase_filters()).astype(float)
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = [700 * (10 ** (m / 2595) - 1) for m in np.linspace(mel(20), mel(8000), 42)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(201), np.arange(400)) / 400)
    for k in (0, 3, len(whole) - 1):
        frame = np.zeros(400)
        part = signal[160 * k : 160 * k + 400]
        frame[: len(part)] = part
        power = np.abs(turn @ (frame * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(400) / 399)))) ** 2
        bands = [sum(p * max(0, min((40 * i - a) / (b - a), (c - 40 * i) / (c - b))) for i, p in enumerate(power)) for a, b, c in zip(edges, edges[1:], edges[2:], strict=False)]
        assert np.allclose(whole[k], np.log(np.array(bands) + 1e-6), atol=2e-2)
    monkeypatch.setattr(audio_features, "BLOCK", audio_features.PATCH)
    assert np.allclose(np.concatenate([m for m, _ in audio_features.log_mel(raw)]), whole, atol=1e-4)
    _, media, tensors, starts, ends = audio_features.media_row(1, text)
    back = np.concatenate(list(audio_features.stored_frames(tensors)))
    assert np.array_equal(back, np.concatenate([m for m, _ in audio_features.log_mel(audio_features.read_wav(media)[0])]))
    table = audio_features.read_tensors(tensors)
    assert audio_features.digest(1, text)[-1].startswith(f"logmel[{len(whole)}x40]:") and table["start_s"].to_pylist() == [i * 0.64 for i in range(-(-len(whole) // 64))]


def test_media_columns(odd):
    for r in audio_features.media_columns(odd).collect():
        assert audio_features.read_tensors(r["tensors"]).num_rows and len(r["segment_starts_s"]) == len(r["segment_ends_s"])


# ---------------------------------------------------------------- hosts


def test_hosts_oracle(spark):
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    key = lambda df: sorted(map(str, df[["page_id", "host", "path", "rule", "verdict"]].fillna("-").values.tolist()))
    assert key(entries.op4_host_reputation(spark, SF).toPandas()) == key(c.sql(host_reputation.ORACLE_SQL).df())


def test_hosts_odd(spark):
    urls = [None, "", "no scheme", "http://", "HTTPS://WWW.Example.COM/en/x?y", "http://example.com/en/", "http://example.com/enx", "http://a.net/fr/", "http://net/es/", "http://xnet/es/", "x://É.com?/a", "http://a://b.org/c#d", "http://com"]
    pages = spark.createDataFrame([(i, u, None if i % 4 == 0 else "ok ###" if i % 4 == 1 else "ok") for i, u in enumerate(urls)] * 2, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in host_reputation.judge(pages, host_reputation.markup_outcomes(pages)).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/en/x", "www.example.com/en/"), ("example.com", "/en/", "example.com/en/"), ("example.com", "/enx", "com/"),
        ("a.net", "/fr/", "net/fr/"), ("net", "/es/", "net/es/"), ("xnet", "/es/", None), ("É.com", "", None), ("a:", "//b.org/c", None), ("com", "", None),
    ]
    assert host_reputation.judge(pages, host_reputation.markup_outcomes(pages)).count() == 2 * len(urls)
    empty = pages.limit(0)
    assert host_reputation.judge(empty, host_reputation.markup_outcomes(empty)).count() == 0
    assert {r["verdict"] for r in host_reputation.judge(pages, host_reputation.markup_outcomes(empty)).collect()} <= {"allow", "block"}


def test_hosts_beyond_the_broadcast(spark, monkeypatch):
    want = sorted(map(tuple, entries.op4_host_reputation(spark, SF).collect()), key=str)
    monkeypatch.setattr(host_reputation, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, entries.op4_host_reputation(spark, SF).collect()), key=str) == want


def test_domains_and_outcomes(spark):
    rows = [("a.b.co.uk",), ("b.co.uk",), ("x.y.example.com",), ("com",), ("",), ("co.uk",)]
    df = spark.createDataFrame(rows, "host string")
    got = [tuple(r) for r in df.select(host_reputation.domain_of(F.col("host")), host_reputation.suffix_of(F.col("host"))).collect()]
    assert got == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("example.com", "com"), ("com", "com"), ("", ""), ("co.uk", "co.uk")]
    html = ["<p>plain words in a row</p>", "<p>a$$$ b### 12 %%%</p>", "<script>var abcdefgh;</script>&amp;", None, "<!-- abc --><b>x</b>" + "<i>word</i> " * 50_000, "<style>abc</style>"]
    pages = spark.createDataFrame([(f"http://h{i}.org/{'p' * 40_000 if i == 4 else ''}", t, "x", 1.0) for i, t in enumerate(html)], "url string, html string, host string, bound double").withColumn("page_id", F.monotonically_increasing_id())
    assert [r["good"] for r in host_reputation.markup_outcomes(pages).collect()] == [True, False, False, None, True, False]
    assert host_reputation.judge(pages, host_reputation.markup_outcomes(pages)).count() == len(html)


def test_reputation_shrinks(spark):
    rows = [("http://good.a.org/", True)] * 200 + [("http://bad.a.org/", False)] * 200 + [("http://new.a.org/", True)] + [("http://x.b.org/", True)] * 50
    table, _ = host_reputation.reputation(spark.createDataFrame(rows, "url string, good boolean"))
    mean = {r["host"]: r["mean"] for r in table.collect()}
    assert mean["good.a.org"] > 0.95 and mean["bad.a.org"] < 0.05 and 0.3 < mean["new.a.org"] < 0.9


def test_new_hosts_lean_on_their_domain(spark):
    rows = [(f"http://h{i % 20}.bad.org/", False) for i in range(400)] + [(f"http://h{i % 20}.good.org/", True) for i in range(400)]
    rows += [(f"http://h.d{i % 40}.info/", False) for i in range(400)] + [(f"http://h.d{i % 40}.dev/", True) for i in range(800)]
    outcomes = spark.createDataFrame(rows, "url string, good boolean")
    urls = ["http://new.bad.org/", "http://new.good.org/", "http://new.else.info/", "http://new.else.dev/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in host_reputation.judge(pages, outcomes, rules=(), min_bound=0.6).collect()}
    assert got == {0: "block", 1: "allow", 2: "block", 3: "allow"}


# ---------------------------------------------------------------- BPE and packing

POOL = ["a", "B", " ", "  ", "\n", "\t", "é", "é", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|ENDoftext|>", "'s", "'LL", "12", "³", "Ⅷ", "中文", "\xa0", "\u2003", "\x1c", "\x1f", "\x85", "😀", "‍", "ſ", "ǅ", "ﬁ", "'", "''", "!!", "aaa", "ΟΔΟΣ ", "\ufeff", "\x00", "ß", "foo", " bar", "."]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_is_the_library(name, docs):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(public_tokenizers.path(name)), bpe.FlatBpe.from_file(public_tokenizers.path(name))
    rng = random.Random(3)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + list(texts_of(docs).values())
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    own.kept = 50
    own._clear()
    got = [x for a in range(0, len(texts), 500) for x in own.encode(texts[a : a + 500])]
    assert [np.frombuffer(i, "<u4").tolist() for i in got] == want
    decoded = library.decode_batch(want, skip_special_tokens=False)
    assert [own.decode(i) for i in got] == decoded == [x.decode() for x in own.decode_all(got)]


def test_bpe_tables_are_bounded_by_bytes():
    own = bpe.FlatBpe.from_file(public_tokenizers.path("word_bpe_49k.json"), 100)
    for k in range(6):
        list(own.encode([" ".join(f"{'ab' * 4000}{k}x{i}" for i in range(30))]))
    own.encode(["x"])
    assert len(own.plain) + len(own.plain.old or ()) <= 2 * 31


def test_bpe_odd(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = {r["doc_id"]: r for r in bpe.encode_digests(odd, path).collect()}
    assert rows[0]["n_tokens"] == 0 and rows[0]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == rows[0]["decoded_sha256"]
    assert bpe.encode_digests(none, path).count() == 0
    assert {r["doc_id"]: len(r["ids"]) for r in bpe.encode_documents(odd, path).collect()} == {i: r["n_tokens"] for i, r in rows.items()}


def plain_best_fit(counts, capacity):
    """Best fit of single documents, the longest first: the number of sequences."""
    gaps = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        at = min((i for i, g in enumerate(gaps) if g >= length), key=lambda i: gaps[i], default=None)
        if at is None:
            gaps.append(capacity)
            at = len(gaps) - 1
        gaps[at] -= length
    return len(gaps)


def packed_in_rounds(counts, capacity):
    state, placed = [(0, length, n, 0) for length, n in counts.items()] + [(2, 0, 0, 0)], []
    while any(kind == 0 for kind, *_ in state):
        rows = packing._round(state, capacity)
        placed += [(size, low, low + n, first, offset) for kind, size, n, first, low, offset in rows if kind == 3]
        state = [r[:4] for r in rows if r[0] != 3]
    return placed


def sequences_of(counts, placed, capacity):
    """How many sequences hold all documents, each rank once, without a hole and within the capacity."""
    used, ranks = defaultdict(list), defaultdict(list)
    for length, low, high, first, offset in placed:
        ranks[length] += range(low, high)
        for r in range(low, high):
            used[first + r - low].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_plan_is_tight():
    rng = random.Random(1)
    for _ in range(30):
        counts = Counter(rng.randint(1, 50) for _ in range(rng.randint(0, 400)))
        least = -(-sum(k * n for k, n in counts.items()) // 50)
        assert least <= sequences_of(counts, packed_in_rounds(counts, 50), 50) <= plain_best_fit(counts, 50)
    for low, high in ((200, 400), (100, 300), (1, 60), (1, 1024), (7, 7)):
        counts = Counter(rng.randint(low, high) for _ in range(1000))
        assert sequences_of(counts, packed_in_rounds(counts, 1024), 1024) <= 1.01 * plain_best_fit(counts, 1024)


def test_a_sweep_gives_gaps_to_the_longest_that_fits():
    rng = random.Random(5)
    for _ in range(50):
        docs, gaps = Counter(rng.randint(1, 9) for _ in range(30)), Counter(rng.randint(1, 9) for _ in range(20))
        want, left = Counter(), Counter(docs)
        for gap in sorted(gaps.elements()):
            length = max((k for k, n in left.items() if n and k <= gap), default=None)
            if length:
                left[length] -= 1
                want[length, gap] += 1
        found = Counter()
        for length, gap, _, n in packing._sweep(dict(docs), {g: [(100 * g, n)] for g, n in gaps.items()}):
            found[length, gap] += n
        assert found == want


def test_rounds_on_the_cluster(spark):
    counts = Counter(random.Random(2).randint(1, 50) for _ in range(300))
    frame = spark.createDataFrame(list(counts.items()), "length long, n long").repartition(3)
    placed = [tuple(r) for r in packing.plan(frame, 50).select("length", "low", "high", "first", "offset").collect()]
    assert sorted(placed) == sorted(packed_in_rounds(counts, 50))
    assert packing.plan(frame.limit(0), 50).count() == 0


def test_packing(odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(odd, path).toPandas()
    by_doc = {i: g.sort_values("piece") for i, g in rows.groupby("doc_id")}
    assert sorted(rows[rows.doc_id.isna()].length) == [len(library.encode("no id", add_special_tokens=False).ids) + 1]
    twice = len(library.encode("One two three.", add_special_tokens=False).ids) + 1
    assert by_doc[5].length.tolist() == [twice, twice] and by_doc[5].piece.tolist() == [0, 0] and by_doc[0].length.tolist() == [1]
    for r in odd.where("doc_id is not null and doc_id <> 5").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        g = by_doc[r["doc_id"]]
        assert g.length.sum() == len(ids) and g.piece.tolist() == list(range(len(g))) and (g.length.iloc[1:] == 1024).all()
        for p in g.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    check_sequences(rows)
    assert packing.pack_documents(none, path).count() == 0


def check_sequences(rows):
    ordered = rows.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 1024


# ---------------------------------------------------------------- search


def test_top_k(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-9, 9, (300, 5))
    base[100:160] = base[0]
    rows = [(i, [float(v) / 8 for v in x]) for i, x in enumerate(base)] + [(301, None), (302, [None, 1.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5), (400, [1.0, 2.0]), (500, [3.0, 4.0]), (None, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    quantized = df.select("vec_id", ball_tree.quantize(F.col("embedding")).alias("vector"))
    ints = {i: np.floor(1024 * np.array(v, float)).astype(int) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q, x in ints.items():
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in ints.items() if i != q and len(y) == len(x))[:10]
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    for shard, block in ((16_384, 8_192), (40, 4)):
        found = ball_tree.top_k(quantized, F.col("vec_id") % 20 == 0, 10, shard, block).collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert ball_tree.top_k(quantized.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_large_numbers():
    x = np.array([[2**29, 3], [2**29 - 1, 5], [-(2**29), 1]], np.int64)
    ids, scores = ball_tree.BallTree(np.arange(3), x).search(np.array([9]), x[:1], 3, np.array([np.iinfo(np.int64).min]))
    assert ids.tolist() == [[0, 1, 2]] and scores.tolist() == [[2**58 + 9, 2**29 * (2**29 - 1) + 15, -(2**58) + 3]]


# ---------------------------------------------------------------- near duplicates and passages


def brute_components(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k : k + size]) for k in range(len(w) - size + 1)])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    where = defaultdict(list)
    for i in ids:
        for j in {j for s in sets[i] for j in where[s]}:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            where[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = {}
    for i in range(140):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts[i] = " ".join(words)
    for i in range(140, 200):
        texts[i] = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) + " one very common line of words that many share"
    return texts | {200: None, 201: "", 202: "Two Words", 203: "two\x0bwords", 204: "Éa b c", 205: "éa b c", 206: " ", 207: "one"}


def second_family():
    """Documents that share few of the leader's shingles but each other's, so that they are linked below it only; and singles."""
    rng = random.Random(21)
    base = [f"b{i}" for i in range(100)]
    texts = {i: " ".join([*base[:100], f"z{i}"]) for i in range(60)}
    texts |= {100 + i: " ".join([*base[:92], *[f"y{k}" for k in range(10)], f"x{i}"]) for i in range(60)}
    for i in range(200, 240):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(100)] = f"q{rng.randrange(30)}"
        texts[i] = " ".join(words)
    return texts


@pytest.mark.parametrize("way", ["usual", "beyond"])
@pytest.mark.parametrize("make", [near_copies, second_family])
def test_near_duplicates(spark, monkeypatch, way, make):
    if way == "beyond":  # the ways beyond the bounds of broadcasts, and classes looked up
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(near_dedup, "HOT", 1)
        monkeypatch.setattr(near_dedup, "ESTIMATED", 40)
        monkeypatch.setattr(linking, "PAIRS_EACH", 0)
    texts = make()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    for size, percent in ((3, 85), (5, 80)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, size, percent).collect()}
        assert got == brute_components(texts, size, percent)


def test_near_duplicates_sql(spark):
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    key = lambda df: sorted(map(tuple, df[["doc_id", "n_shingles", "component_id", "kept"]].values.tolist()))
    want = key(c.sql(near_dedup.ORACLE_SQL).df())
    assert key(entries.op7_hyperminhash(spark, SF).toPandas()) == want and sum(not r[3] for r in want) > 5


def test_near_duplicates_odd(odd, none):
    rows = near_dedup.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == 15 and {(r["doc_id"], r["component_id"], r["kept"]) for r in rows if r["doc_id"] in (5, 6, 10, 11, 0, 1, None)} == {(5, 5, True), (6, 5, False), (10, 10, True), (11, 10, False), (0, 0, True), (1, 1, True), (None, None, True)}
    assert near_dedup.near_duplicates(none).count() == 0
    kept = near_dedup.drop_near_duplicates(odd, 3, 85)
    assert kept.columns == odd.columns and kept.count() == 13


def test_rows_that_share_an_id(spark):
    """Rows with one doc_id and different texts, in any order: each has its own links, and no text is lost."""
    rows = [(1, "a b c d e f g"), (2, "t u v w x y z"), (2, "a b c d e f g"), (3, "t u v w x y z"), (3, "t u v w x y z"), (4, "t u v w x y z")]
    want = [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (3, 2, False), (4, 2, False)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, 3, 85).collect()) == want
        kept = [tuple(r) for r in near_dedup.drop_near_duplicates(df, 3, 85).collect()]
        assert {i for i, _ in kept} == {1, 2} and {t for _, t in kept} == {t for _, t in rows}


def joined_rows(df):
    """Rows that all joins of a plan have made."""
    df.collect()
    total = []

    def walk(node):
        if "Join" in node.nodeName():
            total.append(node.metrics().apply("numOutputRows").value())
        if "QueryStage" in node.nodeName():
            walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan)
    return sum(total)


def test_second_family_makes_few_pairs(spark):
    """m documents of one component below the leader of another, and three singles: pairs grow with m, not with its square."""
    made = []
    for m in (100, 200):
        rows = [(1, 10 + i, 60, 60, 5, True, [7, 8, 9, *range(1000 + 3 * i, 1003 + 3 * i)]) for i in range(m)]
        rows += [(1, 900 + i, 60, 60, 50 + i, True, [7, *range(9000 + 6 * i, 9006 + 6 * i)]) for i in range(3)]
        made.append(joined_rows(linking.linked_below(spark.createDataFrame(rows, "lead long, x long, n long, lead_n long, at long, outside boolean, diff array<long>"), 50)))
    assert 100 < made[0] and made[1] < 3 * made[0]


def test_registers_are_those_of_the_least_values():
    rng = np.random.default_rng(7)
    for n in (1, 5, 300, 5_000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        held = near_dedup.registers(hashes)
        for j in range(near_dedup.BUCKETS):
            inside = [int(h) * near_dedup.BUCKETS for h in hashes.tolist() if int(h) * near_dedup.BUCKETS >> 64 == j]
            if inside:
                least = min(x % 2**64 for x in inside)
                zeros = 64 - least.bit_length()
                mantissa = (least << zeros >> (63 - near_dedup.MANTISSA)) % 2**near_dedup.MANTISSA
                assert held[j] == j << 16 | zeros << near_dedup.MANTISSA | mantissa


def test_collisions_by_simulation(monkeypatch):
    """Registers of sets without a common shingle are equal as often as the correction says, whatever the sizes."""
    monkeypatch.setattr(near_dedup, "MANTISSA", 3)
    rng = np.random.default_rng(3)
    for n, m in ((800, 800), (800, 6_000), (6_000, 6_000)):
        equal = []
        for _ in range(150):
            a, b = (np.sort(rng.integers(0, 2**64, k, dtype=np.uint64)) for k in (n, m))
            equal.append((near_dedup.registers(a) == near_dedup.registers(b)).mean())
        assert abs(np.mean(equal) / near_dedup.collisions(n, m) - 1) < 0.12


def test_estimate():
    rng = np.random.default_rng(4)
    errors = []
    for j in (0.5, 0.8, 0.95):
        for _ in range(30):
            pool = np.unique(rng.integers(0, 2**63, 1200).astype(np.uint64) * np.uint64(2))
            both = int(len(pool) * j)
            rng.shuffle(pool)
            one, two = pool[: both + (len(pool) - both) // 2], np.concatenate([pool[:both], pool[both + (len(pool) - both) // 2 :]])
            errors.append(near_dedup.estimate(near_dedup.registers(np.sort(one)), near_dedup.registers(np.sort(two)), len(one), len(two)) - both / len(pool))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_take_one_task_and_many_the_cluster(spark, monkeypatch):
    """Both ways give the same components; up to FEW edges are not iterated over."""
    rng = random.Random(16)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i + 1, i) for i in range(400, 460)] + [(900, -(10**12) - i) for i in range(30)]
    df, written, real = spark.createDataFrame(edges, "a long, b long"), [], materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name: written.append(name) or real(df, name))
    found = []
    for few in (graph.FEW, 0):
        monkeypatch.setattr(graph, "FEW", few)
        found.append({r["node"]: r["component"] for r in graph.components(df).collect()})
    assert found[0] == found[1] and len(found[0]) > 200 and found[0][900] == -(10**12) - 29
    assert written[:2] == ["edges", "components-of-few"] and written[2] == "edges" and set(written[3:]) == {"stars"}


def test_written_steps_leave_no_shuffle_files(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, given = files(), spark.conf.get(key, None)
    out = materialize(spark.range(5000).groupBy((F.col("id") % 70).alias("k")).count().join(spark.range(70).withColumnRenamed("id", "k").repartition(3), "k"), "summed")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key, None) == given
    assert out.count() == 70 and out.agg(F.sum("count")).first()[0] == 5000


def test_paragraph_places():
    texts = ["Hello World foo bar baz qux " * 5 + "é ünïcode text Words, and end", None, "", " \n ", "one", "the the " * 200]
    p = passage_dedup.Paragraphs([(t or "").encode() for t in texts])
    found = p.places(p.starts, p.count)
    for k in range(len(p.starts)):
        t = texts[found["doc"][k]]
        part = t[found["start"][k] : found["end"][k]]
        assert part.strip() == part and part.split() == t.split()[found["at"][k] :][: p.count[k]] and p.count[k] <= passage_dedup.MAX_WORDS
        assert found["closes"][k] == (found["at"][k] + p.count[k] == len(t.split()))
    assert sum(p.count) == sum(len((t or "").split()) for t in texts)


def passages():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(5000)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [words(n) for n in (51, 60, 90, 200)]
    texts = {}
    for i in range(60):
        parts = [words(rng.randint(5, 120))]
        if i % 3 == 0:
            parts += [shared[i // 3 % 4], words(rng.randint(0, 60))]
        texts[i] = " ".join(parts)
    return texts, shared


@pytest.mark.parametrize("way", ["usual", "beyond"])
def test_repeated_passages(spark, monkeypatch, way):
    if way == "beyond":
        monkeypatch.setattr(passage_dedup, "SMALL", 1)
        monkeypatch.setattr(passage_dedup, "HOT", 1)
        monkeypatch.setattr(passage_dedup, "_OWNERS", 1)
        monkeypatch.setattr(linking, "PAIRS_EACH", 0)
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    texts, shared = passages()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = passage_dedup.repeated_passages(df).collect()
    assert {r["doc_id"] for r in found} == {i for i in texts if i % 3 == 0}
    assert all(r["kept"] == (r["doc_id"] == r["first_doc_id"]) for r in found)
    left = texts_of(passage_dedup.remove_repeats(df, passage_dedup.repeated_passages(df)))
    for nth, s in enumerate(shared):
        assert sum(s in t for t in left.values()) == 1 and s in left[nth * 3]
    assert all(left[i] == t for i, t in texts.items() if i % 3)


@pytest.mark.parametrize("small", [1, 32])
def test_near_links_are_all_found(spark, monkeypatch, small):
    """Every pair of one-paragraph texts at the threshold, by brute force, is in one component: a recall of 1."""
    monkeypatch.setattr(passage_dedup, "SMALL", small)
    monkeypatch.setattr(linking, "PAIRS_EACH", 0 if small == 1 else 4)
    rng, texts = random.Random(5), {}
    while len(texts) < 240:
        words = [f"q{rng.randrange(10**6)}" for _ in range(rng.randint(12, 18))]
        edited = list(words)
        edited[rng.choice([0, 1, -1, -2])] = "zz"
        pair = [" ".join(w) for w in (words, edited)]
        if all(len(passage_dedup.Paragraphs([t.encode()]).starts) == 1 for t in pair):
            texts |= {len(texts): pair[0], len(texts) + 1: pair[1]}
    want = {i for i, (_, c) in brute_components(texts, 5, 80).items() if c != i}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["first_doc_id"] for r in passage_dedup.repeated_passages(df).collect()}
    assert len(want) > 30 and {i for i, f in found.items() if f != i} == want and all(found[i] == i - 1 for i in want)


def test_passages_are_removed_whole(spark):
    """Passages of 51 words between random ones: every copy but the first goes with each of its words, and of what is beside it at
    most the few words by which a similar paragraph differs."""
    rng, texts = random.Random(12), {}
    words = lambda n: [f"v{rng.randrange(10**7)}" for _ in range(n)]
    shared = [words(51) for _ in range(150)]
    around = [(words(60), words(60)) for _ in range(300)]
    for i, (a, b) in enumerate(around):
        texts[i] = " ".join([*a, *shared[i % 150], *b])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    left = texts_of(passage_dedup.remove_repeats(df, passage_dedup.repeated_passages(df)))
    assert all(left[i] == texts[i] for i in range(150))
    beside = []
    for i in range(150, 300):
        rest = left[i].split()
        assert not set(rest) & set(shared[i - 150]), i
        beside.append(120 - len(rest))
        assert set(rest) <= set(around[i][0]) | set(around[i][1])
    assert max(beside) <= 6 and beside.count(0) > 100


def test_boilerplate_makes_few_pairs(spark, monkeypatch):
    """Short texts that differ in their last word alone: the rows of all joins grow with their number, not with its square."""
    made, real = [], materialize

    def counted(df, name):
        out = real(df, name)
        made[-1] += joined_rows(df)
        return out

    for module in (passage_dedup, linking, graph):
        monkeypatch.setattr(module, "materialize", counted)
    for m in (150, 300):
        made.append(0)
        df = spark.createDataFrame([(i, f"all rights are reserved by the owners of page {i}") for i in range(m)], "doc_id long, text string")
        assert passage_dedup.repeated_passages(df).count() == 0
    assert m < made[1] < 2.6 * made[0]


def test_a_frequent_line_that_varies(spark):
    """Families of near paragraphs that share a line with many others: links are those of brute force."""
    rng, texts = random.Random(31), {}
    single = lambda words: len(passage_dedup.Paragraphs([" ".join(words).encode()]).starts) == 1
    lines = [[f"p{j}", *"line is shared by very many texts".split()] for j in range(300)]
    line = max(lines, key=lambda x: sum(single([*x, *(f"s{i}w{k}" for k in range(8))]) for i in range(20)))
    for i in range(600):
        words = [*line, *([f"f{i % 7}w{k}" for k in range(8)] if i % 4 == 0 else [f"t{i}w{k}" for k in range(rng.randint(4, 9))])]
        words[-1] = f"z{i}" if rng.random() < 0.6 else words[-1]
        if single(words):
            texts[i] = " ".join(words)
    wanted = {i: c for i, (_, c) in brute_components(texts, 5, 80).items() if c != i}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["first_doc_id"] for r in passage_dedup.repeated_passages(df).collect()}
    assert len(texts) > 100 and len(wanted) > 10 and {i: f for i, f in found.items() if f != i} == wanted


def test_short_repeats_beside_kept_places_stay(spark):
    """What repeats in less than 12 words stays, also between places that are the first of a passage, and gives no row."""
    rng, texts = random.Random(3), {}
    cut = lambda words: passage_dedup.Paragraphs([" ".join(words).encode()]).count.tolist()
    while len(texts) < 15:
        words = [f"h{rng.randrange(10**7)}" for _ in range(70)]
        sizes = cut(words)
        short = words[sizes[0] : sum(sizes[:2])]
        line = [f"l{rng.randrange(10**7)}" for _ in range(12)]
        if len(short) <= 9 and cut(short) == [len(short)] and cut(line) == [12] and cut(line[:11]) == [11]:
            for some in (short, words, [f"t{rng.randrange(10**7)}" for _ in range(50)] + words, line, line[:11]):
                texts[len(texts)] = " ".join(some)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = passage_dedup.repeated_passages(df)
    assert {r["doc_id"] for r in found.collect()} == {i for i in texts if i % 5 in (1, 2)}
    left = texts_of(passage_dedup.remove_repeats(df, found))
    assert all(left[i] == t for i, t in texts.items() if i % 5 != 2)
    assert all(not set(left[i].split()) & set(texts[i - 1].split()) for i in texts if i % 5 == 2)


def test_rows_that_share_an_id_keep_their_passages(spark):
    """Rows with one doc_id and different texts, in any order, and repeated rows."""
    rng = random.Random(14)
    words = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    one, two, long = words(60), words(60), words(9)
    rows = [(1, f"{words(30)} {one}"), (2, f"{long} {one} {words(40)}"), (2, f"{two} {words(90)}"), (2, "x"), (3, f"{words(20)} {two}"), (3, f"{words(20)} {two}"), (5, words(80)), (5, None)]
    rows[5] = rows[4]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        left = [tuple(r) for r in passage_dedup.remove_repeats(df, passage_dedup.repeated_passages(df)).collect()]
        assert len(left) == len(rows) and sum(one in (t or "") for _, t in left) == 1 == sum(two in (t or "") for _, t in left)
        assert {i for i, t in left if one in (t or "")} == {1} and {i for i, t in left if two in (t or "")} == {2}
        assert [t for i, t in left if i == 3] == [rows[4][1][: -len(two)]] * 2 and (2, "x") in left and (5, None) in left


def test_passages_odd(odd, none):
    rows = passage_dedup.repeated_passages(odd).collect()
    assert {r["doc_id"] for r in rows} == {10, 11}
    assert passage_dedup.repeated_passages(none).count() == 0
    edited = passage_dedup.remove_repeats(odd, passage_dedup.repeated_passages(odd))
    assert edited.columns == odd.columns and edited.count() == odd.count()


def test_passages_on_documents(spark):
    found = {r["doc_id"] for r in entries.op2_passage_dedup(spark, SF).select("doc_id").distinct().collect()}
    words = {r["doc_id"]: (r["text"] or "").lower().split() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    def sharing(n):
        places = defaultdict(set)
        for i, w in words.items():
            for k in range(len(w) - n + 1):
                places[tuple(w[k : k + n])].add(i)
        return {i for v in places.values() if len(v) > 1 for i in v}

    assert sharing(51) <= found <= sharing(12)


# ---------------------------------------------------------------- chat


def test_escapes():
    rng = random.Random(9)
    for _ in range(2000):
        s = "".join(rng.choice(["<", "|", "\\", "a", "<|im_end|>", "\n", "n"]) for _ in range(rng.randint(0, 12)))
        assert chat_format.unescape(chat_format.escape(s)) == s and "<|" not in chat_format.escape(s)
        for template in (chat_format.Template(), chat_format.Template(parts=(("[#/{role}\n", False), ("{text}[#end]", True)), opener="[#"), chat_format.Template(parts=(("{text}<|by|>", True), ("{role}", False)))):
            s = s.replace("<|", template.opener)
            assert chat_format.parse_turn("".join(t for t, _ in chat_format.render_turn(s, s[::-1], template)), template) == (s, s[::-1])


@pytest.mark.parametrize("parts, opener", [((("[{role}]", False), ("{text}[/]\n", True)), "[/]"), ((("{role}{text}", True),), "<|"), ((("<|{text}", True),), "<|"), ((("{role}\n{text}", True),), "<<")])
def test_templates_that_cannot_be_read_back(parts, opener):
    with pytest.raises(ValueError):
        chat_format.Template(parts=parts, opener=opener)


def test_chat_sql(spark):
    c = duckdb.connect()
    c.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    found, want = entries.op10_chat_format(spark, SF).toPandas(), c.sql(chat_format.ORACLE_SQL).df()
    key = lambda df: sorted(map(tuple, df[sorted(want.columns)].values.tolist()))
    assert sorted(found.columns) == sorted(want.columns) and key(found) == key(want)


def test_chat_long_and_clashing(spark):
    long = "<|im_end|> und so weiter \\ " * 40_000
    df = spark.createDataFrame([(1, 0, "user", "q", "x"), (1, 1, "assistant", long, "y")], "conv_id long, turn long, role string, text string, segment string")
    row = chat_format.format_digests(df).collect()[0]
    assert row["loss_chars"] == len(long) and row["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest() and row["valid"]
    assert chat_format.format_segments(df).count() == 6


def test_chat(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a<|im_end|>"), (2, 0, "assistant", None), (2, 0, "assistant", None), (None, 3, None, "x"), (3, 0, "system", "s"), (3, 1, "user", "é"), (3, 2, "assistant", "<\\|é"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.format_digests(df).collect()}
    for c, r in got.items():
        turns = sorted((t if t is not None else -1, role or "", text or "") for i, t, role, text in rows if i == c)
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256("".join(f"{o}\n{x}\n" for _, o, x in turns).encode()).hexdigest()
        learned = "".join(x for _, o, x in turns if o == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert [got[c]["valid"] for c in (1, 2, None, 3)] == [True, False, False, False]
    segments = chat_format.format_segments(df).where("conv_id = 1").orderBy("position").collect()
    assert "".join(s["segment"] for s in segments) == "<|im_start|>user\na<\\|im_end|><|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert [s["segment"] for s in segments if s["loss"]] == ["b"]
    assert chat_format.format_digests(df.limit(0)).count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark, docs, odd, none):
    import corpus_pipeline

    frame, columns, seen = docs, docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == columns
        seen.append((name, frame, out))
        frame = out
    texts = texts_of(seen[2][1])
    components = brute_components(texts, 5, 80)
    assert set(texts_of(seen[2][2])) == {i for i, (_, c) in components.items() if c == i}
    before, after = texts_of(seen[3][1]), texts_of(seen[3][2])
    assert set(before) == set(after) and any(before[i] != after[i] for i in before)
    rows = corpus_pipeline.STAGES[-1][1](spark, frame, SF).toPandas()
    check_sequences(rows)
    assert set(rows.doc_id) == set(after)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).columns and stage(spark, none, SF).count() == 0


def test_entries_have_rows(spark):
    found = entries.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found) == list(range(1, 11))
