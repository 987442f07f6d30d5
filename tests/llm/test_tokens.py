"""Packing, BPE and language identification."""

import base64
import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import SF_SMALL, frame  # noqa: F401 (a fixture)
from hypothesis import given, settings
from hypothesis import strategies as st

from adlift.llm import bpe_monoid, lang_nb, queries, vector_pack

P = pytest.importorskip("public_tokenizers")
ODD = ["", None, " ", "a", "<|endoftext|> and <|endoftext|>", "don't I'll we've 'tis '", "x  y   z \n\n w\t\t", "漢字 かな 😀😀",
       "\u00a0nb\u2028sep\x1c\x85 x", "a" * 30_000, " " * 9000, "word " * 5000, "12 3456 ½ ² Ⅷ", "é\u0301 ﬁ ſ", "tab\tx\r\ny",
       "'" * 5000 + "ll", "no-space-but-marks!" * 700, "x\u200by\ufeffz"]


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check_packing(rows, texts, exact, limit=1024, segments=256):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(docs) == set(texts)
    for i, pieces in docs.items():
        ids = [*exact.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            own = np.array(ids[at:at + p["length"]], dtype="<u4")
            assert p["ids_crc32"] == zlib.crc32(own.tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limit and len(pieces) <= segments
        padding += 0 if at & (at - 1) == 0 else limit - at
    return padding


class TestPacking:
    def test_documents(self, spark, small, exact):
        texts = {r["doc_id"]: r["text"] for r in small.collect()}
        rows = queries.op4_vector_packing(spark, SF_SMALL).collect()
        assert check_packing(rows, texts, exact) == 0

    def test_odd_texts(self, spark, frame, exact):
        docs = frame("doc_id long, text string, start int, length int", [(i, t, 0, 0) for i, t in enumerate(ODD)])
        assert check_packing(queries.pack(docs).collect(), dict(enumerate(ODD)), exact) == 0
        assert queries.pack(docs.limit(0)).count() == 0

    def test_null_ids_and_repeated_rows(self, spark, frame):
        rows = queries.pack(frame("doc_id long, text string", [(None, "a b"), (2**60 + 1, "a b"), (2**60 + 1, "a b")])).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows if r["doc_id"])[0][1] == 2**60 + 1
        assert sum(r["length"] for r in rows) == 9

    @settings(max_examples=150, deadline=None)
    @given(st.text(max_size=80))
    def test_fast_path_equals_the_tokenizers_library(self, exact, text):
        encode = ENCODERS.setdefault("fast", vector_pack.load_encoder(
            P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)) if "fast" not in ENCODERS \
            else ENCODERS["fast"]
        assert encode([text])[0].tolist() == exact.encode(text, add_special_tokens=False).ids

    @settings(max_examples=40, deadline=None)
    @given(st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=60), st.booleans())
    def test_limits_hold_together(self, sizes, cut):
        limits = vector_pack.Limits(tokens=64, segments=5, loss_tokens=40, pool=400)
        out = []
        packer = vector_pack.Packer(limits, lambda s, pieces: out.append(list(pieces)), cut)
        total = 0
        for i, (n, loss) in enumerate(sizes):
            marks = np.zeros(n, dtype=np.int8)
            marks[:min(n, loss)] = 1
            if not cut and (n > 64 or marks.sum() > 40):
                continue
            packer.add(vector_pack.Example(i, np.arange(n, dtype=np.uint32), marks, 0, n))
            total += n
        packer.drain(0)
        assert sum(len(e.ids) for s in out for e in s) == total
        for s in out:
            assert sum(len(e.ids) for e in s) <= 64 and len(s) <= 5 and sum(int(e.loss.sum()) for e in s) <= 40
        if not cut:
            assert all(e.start == 0 and len(e.ids) == e.total for s in out for e in s)


    def test_many_short_documents_pack_in_linear_time_without_padding(self):
        """300,000 one-id documents in one partition; a limit of 256 segments leaves three-id documents unfilled."""
        for n, size in ((300_000, 1), (20_000, 3)):
            out, began = [], time.time()
            packer = vector_pack.Packer(vector_pack.Limits(), lambda s, pieces: out.append([len(e.ids) for e in pieces]))
            one = np.ones(size, dtype=np.uint32)
            for i in range(n):
                packer.add(vector_pack.Example(i, one, one.astype(np.int8), 0, size))
            packer.drain(0)
            assert time.time() - began < 30
            lengths = [sum(s) for s in out]
            assert sum(lengths) == n * size and all(x & (x - 1) == 0 and x <= 1024 for x in lengths)
            assert all(len(s) <= 256 for s in out)

    def test_three_id_documents_need_no_padding(self, spark, frame, exact):
        text = "a b"
        assert len(exact.encode(text, add_special_tokens=False).ids) == 2
        docs = frame("doc_id long, text string", [(i, text) for i in range(20_000)])
        assert check_packing(queries.pack(docs).collect(), {i: text for i in range(20_000)}, exact) == 0

    def test_loss_limit_below_the_token_limit(self, spark, frame, exact):
        """Turns that bear loss fill a sequence's loss limit before its tokens; every id is placed once."""
        rnd = random.Random(4)
        words = ["ask", "answer", "héllo", "世界", "x1"]
        rows = []
        for i in range(120):
            text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))
            a = rnd.randrange(len(text) + 1)
            spans = rnd.choice([None, [], [(a, a + rnd.randrange(40))], [(0, 5), None, (3, 9), (10 ** 6, 10 ** 6 + 1)]])
            rows.append((i, text, spans))
        docs = frame("doc_id long, text string, turns array<struct<start: int, end: int>>", rows)
        limits = vector_pack.Limits(tokens=64, segments=8, loss_tokens=24, pool=512)
        f = queries.tokenizer_files()
        out = vector_pack.pack_documents(docs, f["json"], f["ranks"], f["pattern"], limits, "turns").collect()
        flags, sequences, covered = {}, {}, {}
        for i, text, spans in rows:
            e = exact.encode(text, add_special_tokens=False)
            inside = [spans is None or any(s and s[0] <= p < s[1] for s in spans) for p in range(len(text))]
            flags[i] = [inside[a] for a, _ in e.offsets] + [inside[-1] if text else spans is None]
        for r in out:
            covered.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
            sequences.setdefault(r["sequence_id"], []).append(r)
        for i, own in covered.items():
            own.sort()
            assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
            assert sum(n for _, n in own) == len(flags[i])
        assert set(covered) == set(flags)
        loss = [sum(sum(flags[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in s) for s in sequences.values()]
        size = [sum(r["length"] for r in s) for s in sequences.values()]
        assert max(loss) <= 24 < max(size) <= 64 and all(len(s) <= 8 for s in sequences.values())
        assert all(n & (n - 1) == 0 for n in size)


ENCODERS = {}


def tik():
    if "tik" not in ENCODERS:
        import tiktoken

        with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        ENCODERS["tik"] = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ENCODERS["tik"]


class TestBpe:
    @settings(max_examples=250, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'slvredmta  12.-é漢\u00a0\x1c\x85😀")), st.characters(
        exclude_categories=["Cs"])), max_size=200), st.integers(1, 9))
    def test_tree_equals_tiktoken(self, text, leaf):
        coder = bpe_monoid.MonoidEncoder(tik(), leaf)
        ids = coder.encode(text)
        assert ids == tik().encode_ordinary(text)
        assert coder.decode(ids) == text.encode()

    def test_join_is_associative(self):
        text = "The quick brown fox isn't 'lazy'  at  all; it  jumps 12 345 times. " * 5
        coder = bpe_monoid.MonoidEncoder(tik(), 16)
        a, b = 77, 140
        x, y, z = coder.reduce(text, 0, a), coder.reduce(text, a, b), coder.reduce(text, b, len(text))
        left, right = coder.join(text, coder.join(text, x, y), z), coder.join(text, x, coder.join(text, y, z))
        assert left.ids == right.ids == tik().encode_ordinary(text)

    def test_query(self, spark, small, frame):
        texts = {r["doc_id"]: r["text"] for r in small.collect()}
        rows = queries.op9_bpe_round_trip(spark, SF_SMALL).collect()
        f = queries.tokenizer_files()
        odd = frame("doc_id long, text string, ids int", [(1000 + i, t, 0) for i, t in enumerate(ODD)])
        rows += bpe_monoid.round_trip_digests(odd, f["multi"], f["pattern"], 64).collect()
        texts |= {1000 + i: t for i, t in enumerate(ODD)}
        assert len(rows) == len(texts)
        for r in rows:
            t = texts[r["doc_id"]] or ""
            ids = tik().encode_ordinary(t)
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
                len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        ids = {r["doc_id"]: r["ids"] for r in bpe_monoid.encode_documents(odd, f["multi"], f["pattern"]).collect()}
        assert ids[1003] == tik().encode_ordinary("a") and ids[1001] == []
        assert bpe_monoid.round_trip_digests(odd.limit(0), f["multi"], f["pattern"]).count() == 0


class TestLanguage:
    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
        got = queries.op10_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
        assert len(got) == 1000
        held = [r for r in got if r["held_out"]]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
        assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held) > 100
        assert all(0 <= r["score"] <= 1 for r in got)

    def test_equals_plain_naive_bayes(self, spark):
        """Counts, probabilities and decisions as plain Python makes them, whole result row by row."""
        sf = "/root/testdata/sf0.001"
        docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
        low = (1 << 32) - 1
        buckets = {}

        def bucket(gram):
            if gram not in buckets:
                h = 0
                for c in gram:
                    h = (h ^ ord(c)) * 0x9E3779B1 & low
                    h ^= h >> 15
                buckets[gram] = (h * 0x85EBCA6B + len(gram) - 1 & low) >> 17
            return buckets[gram]

        def grams(text):
            t = "".join(c if c.isalpha() else " " for c in text.lower()) + "  "
            n = Counter()
            for k in (1, 2, 3):
                for gram, times in Counter(t[i:i + k] for i in range(len(t) - 2)).items():
                    n[bucket(gram)] += times
            return n

        held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs}
        found = {d["doc_id"]: grams(d["text"]) for d in docs if d["text"] is not None}
        taught, n_texts = {}, Counter()
        for d in docs:
            if not held[d["doc_id"]] and d["lang"] is not None and d["text"] is not None:
                taught.setdefault(d["lang"], Counter()).update(found[d["doc_id"]])
                n_texts[d["lang"]] += 1
        total = {k: sum(c.values()) + lang_nb.SMOOTHING * lang_nb.BUCKETS for k, c in taught.items()}
        want = {}
        for d in docs:
            text = d["text"]
            if text is None or not any(c.isalpha() for c in text.lower()):
                want[d["doc_id"]] = ("und", 0.0)
                continue
            scores = {k: math.log(n_texts[k] / sum(n_texts.values())) + sum(
                n * math.log((taught[k][b] + lang_nb.SMOOTHING) / total[k]) for b, n in found[d["doc_id"]].items())
                for k in sorted(taught)}
            best = max(scores, key=scores.get)
            want[d["doc_id"]] = (best, 1 / sum(math.exp(s - scores[best]) for s in scores.values()))
        got = queries.op10_language(spark, sf).collect()
        assert len(got) == len(docs) and len(taught) > 1
        for r in got:
            lang, score = want[r["doc_id"]]
            assert (r["held_out"], r["lang_pred"]) == (held[r["doc_id"]], lang)
            assert abs(r["score"] - score) < 1e-3

    def test_counts_do_not_depend_on_slices(self, monkeypatch):
        texts = ["abc déf", "x" * 50, "Überall 12 Wörter", "漢"]
        def counts(size):
            monkeypatch.setattr(lang_nb, "SLICE", size)
            out = np.zeros(lang_nb.BUCKETS, dtype=int)
            for _, points, starts in lang_nb._slices(texts):
                keep = lang_nb._own(starts, len(points))
                for f in lang_nb._features(points):
                    out += np.bincount(f[keep], minlength=lang_nb.BUCKETS)
            return out
        whole = counts(1 << 18)
        assert whole.sum() == 3 * sum(map(len, texts))
        assert (whole == counts(4)).all() and (whole == counts(7)).all()

    def test_corner_cases(self, spark, frame):
        rows = [(1, "der die das und", "de"), (2, "the and of to", "en"), (3, None, "en"), (4, "", "de"), (5, "12 !?", None),
                (6, "und der die", None), (None, "the of", None), (7, "the", None), (7, "the", None), (8, "the of " * 100_000, "en")]
        docs = frame("doc_id long, text string, lang string, score int", [(*r, 0) for r in rows])
        out = lang_nb.classify(docs, lang_nb.train(docs)).collect()
        got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
        assert len(out) == len(rows)
        assert got[3] == got[4] == got[5] == ("und", 0.0)
        assert got[6][0] == "de" and got[None][0] == "en" and got[8][0] == "en"
        untaught = lang_nb.classify(docs, lang_nb.train(docs.limit(0))).collect()
        assert {r["lang_pred"] for r in untaught} == {"und"}
        assert lang_nb.classify(docs.limit(0), lang_nb.train(docs)).count() == 0
