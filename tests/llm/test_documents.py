"""Operators on documents: odd inputs, and brute force on the smallest driver table."""

import hashlib
import os
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import rateflow.llm.language_id as L
from rateflow.llm import queries as Q
from rateflow.llm.language_id import identify
from rateflow.llm.licences import scan
from rateflow.llm.mixing import bisect_exponent, mix, quotas
from rateflow.llm.near_dedup import near_duplicates, signatures
from rateflow.llm.packing import WordEncoder, _pieces, best_fit_decreasing, narrowed, pack, together, widened
from rateflow.llm.quality import cascade
from rateflow.llm.sharding import jump_shards
from rateflow.llm.shingles import probability_jaccard, shingles, word_hashes
from rateflow.llm.suffix_dedup import repeated_spans

SF = "/root/testdata/sf0.001"
on_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
PATH = public_tokenizers.path(Q.VOCABULARY)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def removed(docs, depth):
    """Brute force: (bytes, removed, runs, hash of the rest) by document, in id order."""
    seen, out = set(), {}
    for key, text in docs:
        raw = text.encode()
        cover = bytearray(len(raw))
        for p in range(len(raw) - depth + 1):
            if (w := raw[p:p + depth]) in seen:
                cover[p:p + depth] = b"\1" * depth
            seen.add(w)
        runs = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        rest = bytes(b for b, c in zip(raw, cover, strict=True) if not c)
        out[key] = (len(raw), sum(cover), runs, hashlib.sha256(rest).hexdigest())
    return out


@on_tables
@pytest.mark.parametrize("hot", [None, (3, 12)])
def test_suffix_dedup_equals_brute_force(spark, texts, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(repeated_spans, "__defaults__", (100, hot))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in Q.op5_suffix_dedup(spark, SF).collect()}
    assert got == removed(sorted(texts.items()), 100)


def test_suffix_dedup_of_odd_rows(odd, none):
    rows = [r for r in repeated_spans(odd, 40).collect()]
    assert len(rows) == odd.count() and repeated_spans(none).count() == 0
    kept = defaultdict(set)
    for r in rows:
        kept[r.doc_id].add((bytes(r.kept), len(r.spans)))
    assert kept[1] == kept[2] == {(b"", 0)}
    # the null id comes first and keeps its text; 3 loses the copy, in both of its rows
    assert next(iter(kept[None]))[1] == 0 and (b"", 1) in kept[3] and len(kept[3]) == 2
    assert next(iter(kept[7]))[0] == b"a"  # overlapping copies count: one letter is left of a run


def test_radix_on_a_small_alphabet(spark):
    rng = np.random.default_rng(1)
    docs = [(i, "".join(rng.choice(list("ab"), 300)) * int(rng.integers(1, 3))) for i in range(30)]
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
           for r in repeated_spans(spark.createDataFrame(docs, "doc_id long, text string"), 40).collect()}
    assert got == removed(docs, 40)


@on_tables
def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tokenizer, pieces, sequences = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in Q.op4_packing(spark, SF).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    total = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
        total += at
    assert total / (4096 * len(sequences)) > 0.9


def test_packing_of_odd_rows(odd, none):
    rows = pack(odd, PATH, 2, 64).collect()
    assert pack(none, PATH, 2).count() == 0
    assert sum(r.start == 0 for r in rows) == odd.count()
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    assert max(r.length for r in rows) == 64


def test_pieces_travel_in_16_bits():
    import pyarrow as pa

    text = "It's a plain line, and one more. " * 40
    docs = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "key": [5, 6], "text": [text, ""]})
    ids = [WordEncoder(PATH).ids(t) + np.array([end], "<u4").tobytes() for t, end in ((text, 2), ("", 2), (text, 70_000))]
    rows = pa.Table.from_batches(_pieces(PATH, 2, 64)([docs])).to_pylist()
    assert {len(r["ids"]) / r["length"] for r in rows} == {2}
    for key in (1, 2):
        assert b"".join(widened(r["ids"], r["length"]) for r in rows if r["doc_id"] == key) == ids[key - 1]
    # ids beyond 16 bits stay as they are, in the pieces that hold them
    rows = pa.Table.from_batches(_pieces(PATH, 70_000, 64)([docs.slice(0, 1)])).to_pylist()
    assert [len(r["ids"]) // r["length"] for r in rows] == [2] * (len(rows) - 1) + [4] and len(rows) > 2
    assert b"".join(widened(r["ids"], r["length"]) for r in rows) == ids[2]
    edge = [np.array(x, "<u4").tobytes() for x in ([65_535, 0], [65_536, 0])]
    assert [len(narrowed(x)) for x in edge] == [4, 8] and [widened(narrowed(x), 2) for x in edge] == edge


@pytest.mark.parametrize("end", [2, 65_535, 65_536, 70_000])
def test_packing_gives_32_bit_ids(odd, end):
    encoder, last, want = WordEncoder(PATH), np.array([end], "<u4").tobytes(), Counter()
    for r in odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = encoder.ids(r.text) + last
        want.update((r.doc_id, at // 4, ids[at:at + 256]) for at in range(0, len(ids), 256))
    assert Counter((r.doc_id, r.start, bytes(r.ids)) for r in pack(odd, PATH, end, 64).collect()) == want


def test_words_encode_as_the_tokenizer_does(odd):
    encoder = WordEncoder(PATH)
    extra = ["It's we'll DON'T 12345 a_b c++ ½ µm ÀÉß\u00a0x\u0085y", "Ünï\u0301code ẞ İ Σς ﬁ <|endoftext|> x", "a\x1cb\tc\r\nd"]
    for text in [*(r.text or "" for r in odd.select("text").collect()), *extra]:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want, text[:40]


def test_texts_encoded_together_equal_the_tokenizer():
    encoder, letters = WordEncoder(PATH), [chr(i) for i in range(256)]
    texts = ["", " ", "日本 x", *(f"{a}{b}'{b} x{a}" for a in letters for b in "a'!1 \xa0é" + a), "it's!'s ...a.b 12½a '' 'RE \x0b\x85 "]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want and encoder.encode([]) == [] and encoder.encode([""]) == [b""]
    sizes = [3, 9, 25, 0, 2, 2, 2, 2, 2, 1]
    assert list(together(["x" * n for n in sizes], 10)) == [(0, 2), (2, 3), (3, 9), (9, 10)] and list(together([])) == []


def test_each_piece_is_looked_up_once():
    class Counting(WordEncoder):
        calls = 0

        def __missing__(self, piece):
            self.calls += 1
            return super().__missing__(piece)

    encoder, text = Counting(PATH), "One, two. three!! (four), it's " * 1000
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want
    assert encoder.calls < 20  # words with a mark were put together anew each time they came


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 100, 400).tolist()
    sequence, offset = best_fit_decreasing(lengths, 100)
    left: list[int] = []  # plain best fit: least capacity that fits
    for n in sorted(lengths, reverse=True):
        fits = [c for c in left if c >= n]
        if fits:
            left.remove(min(fits))
        left.append((min(fits) if fits else 100) - n)
    used = Counter()
    for s, n in zip(sequence, lengths, strict=True):
        used[s] += n
    assert sorted(100 - u for u in used.values()) == sorted(left) and max(used.values()) <= 100
    assert len({(s, o) for s, o in zip(sequence, offset, strict=True)}) == len(lengths)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(2)
    names = rng.integers(1, 1 << 63, 14, dtype=np.uint64)  # shingles are hashes
    for _ in range(10):
        sets = []
        for _ in range(2):
            e = np.sort(rng.choice(np.arange(1, 14, dtype=np.uint64), int(rng.integers(1, 9)), replace=False))
            sets.append((names[e], rng.integers(1, 4, len(e))))
        sets = [(h[np.argsort(h)], w) for h, w in sets]
        x, y = (dict(zip(h.tolist(), w.tolist(), strict=True)) for h, w in sets)
        want = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in {*x, *y}) for d in {*x} & {*y})
        assert probability_jaccard(*sets) == pytest.approx(want)
        s = signatures(sets, 1000)
        assert (s[0] == s[1]).mean() == pytest.approx(want, abs=0.08)


@on_tables
def test_near_duplicates_equal_all_pairs(spark, texts):
    sets = {k: shingles(word_hashes(t)) for k, t in texts.items()}
    group = {k: k for k in texts}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and (texts[i] == texts[j] or probability_jaccard(sets[i], sets[j], 0.8) >= 0.8):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    assert {r.doc_id: r.group_id for r in Q.op8_probminhash(spark, SF).collect()} == {k: root(k) for k in texts}


def test_near_duplicates_of_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count() and near_duplicates(none).count() == 0
    group = defaultdict(set)
    for r in rows:
        group[r.doc_id].add(r.group_id)
    assert group[1] == {1} and group[2] == {1}  # null is the empty text
    assert 3 in group[3] and group[5] == {5}


@on_tables
def test_language_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in Q.op10_language_id(spark, SF).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(r.held_out for r in held)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.9


def test_language_of_odd_rows(odd, none):
    rows = identify(odd).collect()
    assert len(rows) == odd.count() and identify(none).count() == 0
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 5)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and rows[0].asDict().keys() >= {"node", "lang", "score"}


def test_languages_in_other_scripts(spark):
    """Letters beyond a to z have vectors of their own."""
    words = {"el": "ένα μικρό κείμενο στα ελληνικά με λίγες λέξεις για όλους", "ru": "небольшой текст на русском языке для всех читателей и людей",
             "uk": "невеликий текст українською мовою для всіх читачів і людей їхніх", "ja": "これは日本語の短い文章です皆さんのためのもの", "de": "größere Bücher über süße Äpfel und schöne Häuser"}
    rng = np.random.default_rng(3)
    rows = [(100 * i + j, " ".join(rng.permutation(w.split())) if " " in w else w[j % 5:], lang) for i, (lang, w) in enumerate(words.items()) for j in range(40)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == r.lang and r.score > 0.3 for r in got)


def test_letters_are_bound_as_described():
    text = "été Дом"
    symbols = [0, *(ord(c) if ord(c) > 122 else ord(c) - 96 for c in "été"), 0, *(ord(c) for c in "дом"), 0]
    letter = {s: L._letters(np.array([s]))[0].astype(int) for s in symbols}
    want = sum(np.roll(letter[a], 2) * np.roll(letter[b], 1) * letter[c] for a, b, c in zip(symbols, symbols[1:], symbols[2:]))
    assert (L.bundle(text) == want).all()


def plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


@on_tables
def test_quality_counts(spark, texts):
    for r in Q.op7_quality_cascade(spark, SF).collect():
        want = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_quality_of_odd_rows(odd, none):
    rows = cascade(odd).collect()
    assert len(rows) == odd.count() and cascade(none).count() == 0
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text or "")


def test_shards(odd, none, spark):
    def jump(key, n):  # the published loop
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
        return b

    ids = spark.range(-300, 3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("shard"))
    rows = jump_shards(ids, "doc_id", 40, rows_per_block=10).collect()
    assert all((r.shard, r.grown_shard) == (jump(r.doc_id % 2**64, 40), jump(r.doc_id % 2**64, 41)) for r in rows)
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    same = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(1).alias("size"))
    rows = jump_shards(same, "doc_id", 4, rows_per_block=50).collect()
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert jump_shards(odd, "doc_id", 5).count() == odd.count() and jump_shards(none, "doc_id", 5).count() == 0


def test_mixing(odd, none, spark):
    assert bisect_exponent([0.5, 0.25, 0.25], repetition=10) == 0
    assert quotas({"a": 800, "b": 200}, repetition=2.0) == {"a": 800, "b": 400}
    assert quotas({"a": 800, "b": 200}, None, entropy=1.0) == {"a": 800, "b": 800}
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"),
                                    F.when(F.col("id") < 3000, "a").when(F.col("id") < 3800, "b").otherwise("c").alias("source"))
    rows = mix(docs, 2.0, block_tokens=20_000, rows_per_range=100).collect()
    have = Counter()
    for r in docs.collect():
        have[r.source] += r.doc_id % 50 + 1
    want = quotas(dict(have), 2.0)
    drawn, copies, blocks = Counter(), Counter(), defaultdict(Counter)
    for r in rows:
        drawn[r.source] += r.n_tokens
        copies[r.doc_id] += 1
        blocks[r.block][r.source] += r.n_tokens
    assert len(copies) == 4000 and max(copies.values()) <= 2
    assert all(want[s] - 50 <= drawn[s] <= want[s] for s in want)
    n = len(blocks)
    assert n > 4 and all(abs(b[s] - want[s] / n) <= 100 for b in list(blocks.values())[:-1] for s in want)
    for b in blocks:
        assert sorted(r.slot for r in rows if r.block == b) == list(range(sum(r.block == b for r in rows)))
    # a third of the rows bear no id and are alike: each is drawn, at a place of its own
    hot = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("one two").alias("text"),
                                   F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("source"))
    rows = mix(hot, 2.0, block_tokens=3000, rows_per_range=100).collect()
    assert sum(r.doc_id is None and r.epoch == 0 for r in rows) == 3000 and len({(r.block, r.slot) for r in rows}) == len(rows)
    assert mix(odd).filter("epoch = 0").count() == odd.count() and mix(none).count() == 0


def test_licences(odd, none, spark):
    rows = {(r.doc_id, r.text): r for r in scan(odd).collect()}
    assert len(scan(odd).collect()) == odd.count() and scan(none).count() == 0
    assert {k[0]: r.licence for k, r in rows.items() if r.licence} == {9: "mit"}
    assert [r.licence_at for r in rows.values() if r.licence] == [0]


def test_licences_with_a_very_long_line(spark):
    """A line of 50,000 words takes time in proportion to them."""
    line = " ".join(f"word{i % 977}" for i in range(50000))
    begun = time.monotonic()
    got = scan(spark.createDataFrame([(1, f"{line}\nReleased under the MIT License."), (2, line)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.licence, r.licence_at) for r in got} == {1: ("mit", 1), 2: (None, None)}
    assert time.monotonic() - begun < 60


@on_tables
def test_licences_of_the_documents(spark, texts):
    lines = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit",
             "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "proprietary"}
    want = {k: next((lines[x] for x in t.split("\n") if x in lines), None) for k, t in texts.items()}
    assert {r.doc_id: r.licence for r in Q.op2_licence_scan(spark, SF).collect()} == want
