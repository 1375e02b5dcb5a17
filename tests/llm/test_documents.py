"""Operators over documents against plain versions, on every odd kind of row."""

import collections
import functools
import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from contactloom.llm import packing
from contactloom.llm import passages as repeats
from contactloom.llm import quality as q
from contactloom.llm.decontaminate import masks, passages, without_passages
from contactloom.llm.licenses import scan_licenses
from contactloom.llm.near import distance_limit, keep_one, near_duplicates
from contactloom.llm.packing import first_fit, pack, sequences, token_bytes
from contactloom.llm.passages import remove_repeats
from contactloom.llm.tokens import Counter, read_vocabulary, token_counts
from contactloom.llm.words import split_words, text_buffer, window_hashes
from tests.llm.conftest import edge_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def key(value):
    return (value is None, value)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()),
                  key=lambda r: tuple(key(v) for v in r))


# -- near duplicates ----------------------------------------------------------------------

def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def plain_components(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                label[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows))
               if find(j) == find(i) and rows[j][0] is not None]
        low = (min(ids) if ids else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), low, doc_id == low))
    return sorted(out, key=lambda r: tuple(key(v) for v in r))


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_on_odd_rows(edge_docs, width):
    got = rows_of(near_duplicates(edge_docs, width), "doc_id", "n_shingles", "component_id",
                  "kept")
    assert got == plain_components([r[:2] for r in edge_rows()], width, 80)


def family(base, copies):
    """Copies of one text with growing edits, so that links form chains and stars."""
    out = []
    for k in range(copies):
        text = words(150, base)
        for e in range(k % 9):
            text[(17 * e + 5 * k) % 150] = f"edit{base}x{k}x{e}"
        out.append(" ".join(text))
    return out


def test_near_duplicates_find_every_link_of_large_families(spark):
    texts = family(100, 70) + family(200, 40) + [" ".join(words(100, s)) for s in range(40)]
    rows = [((i * 7919) % 1000, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(near_duplicates(docs, 4), "doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_components(rows, 4, 80)


def test_near_duplicates_of_nothing(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert keep_one(no_docs).count() == 0


def test_keep_one_keeps_columns_and_one_of_each_group(edge_docs):
    got = keep_one(edge_docs, 4)
    assert got.columns == edge_docs.columns
    want = {r[0] for r in plain_components([r[:2] for r in edge_rows()], 4, 80) if r[3]}
    assert collections.Counter(r.doc_id for r in got.collect() if r.doc_id) == {
        **dict.fromkeys(want - {None}, 1)}


def test_distance_limit_is_five_deviations_above_the_mean():
    assert distance_limit(0.8) == 273


# -- passages -----------------------------------------------------------------------------

def plain_removal(texts, width):
    sequences_of = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + width]) for w in sequences_of
                               for i in range(len(w) - width + 1))
    out = []
    for w in sequences_of:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(),
                    kept))
    return out


@pytest.mark.parametrize("width", [35, 12])
def test_repeats_on_odd_rows(edge_docs, width):
    got = remove_repeats(edge_docs, width).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "text", "shard", "node")
    want = plain_removal([r[1] for r in edge_rows()], width)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        ((r[0], *p[:3]) for r, p in zip(edge_rows(), want, strict=True)),
        key=lambda r: tuple(key(v) for v in r))
    for row in got.collect():
        kept = " ".join(WORD.findall(row.text))
        assert hashlib.sha256(kept.encode()).hexdigest() == row.kept_sha256
        assert (row.shard, row.node) == ("x", "z")


def test_repeats_within_periodic_and_overlapping_texts(spark):
    a, b = words(200, 11), words(200, 12)
    texts = [" ".join(words(7, 13) * 20), " ".join(a[:90] + b[:40]), " ".join(a[50:120]),
             " ".join(b[:36] + a[84:130]), " ".join(a[86:120]), " ".join(words(34, 14))] * 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = plain_removal(texts, 35)
    assert got == [(i, *p[:3]) for i, p in enumerate(want)]


def test_passages_go_to_the_shards_that_have_their_windows(spark, monkeypatch):
    """A phrase in many passages and shards does not bring each passage to each shard."""
    def least(k):
        phrase = " ".join(words(8, 1000 + k))
        return window_hashes(split_words(pa.array([phrase])).hashes, 8)[0], phrase

    phrase = min(map(least, range(5000)))[1]
    texts = [" ".join([*words(40, 2 * i + 100), phrase, *words(40, 2 * i + 101)])
             for i in range(60)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    locate = repeats.locate

    def counted(width, columns):
        plain = locate(width, columns)

        def run(own, passages):
            out = plain(own, passages)
            sent = pa.array([passages.num_rows] * out.num_rows, pa.int64())
            return out.set_column(out.column_names.index("n_words"), "n_words", sent)

        return run

    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    monkeypatch.setattr(repeats, "locate", counted)
    got = rows_of(remove_repeats(docs), "doc_id", "n_words", "n_removed")
    assert [r[2] for r in got] == [88] * 120
    # On average a shard has five texts, each of one passage
    assert max(r[1] for r in got) <= 20


@pytest.mark.parametrize("common", [0, 4096])
def test_repeats_in_rounds(spark, monkeypatch, common):
    """Many shards, rounds, buckets and pieces give what one gives."""
    shared = [words(60, s) for s in range(3)]
    texts = [" ".join(words(30, 50 + i) + shared[i % 3][i % 7:] + words(40, 90 + i % 11))
             for i in range(40)] + [" ".join(words(700, 7))] * 3 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for name, value in (("SHARD_BYTES", 1500), ("ROUND_SHARE", 0.4), ("BUCKET_WINDOWS", 50),
                        ("COMMON", common), ("PIECE", 9)):
        monkeypatch.setattr(repeats, name, value)
    labels = []
    written = repeats.written
    monkeypatch.setattr(repeats, "written", lambda df, label, *codec: (
        labels.append(label), written(df, label, *codec))[1])
    got = rows_of(remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert labels.count("homes") > 1
    assert got == [(i, *p[:3]) for i, p in enumerate(plain_removal(texts, 35))]


def test_a_round_takes_its_share_of_the_windows_once():
    own = words(3000, 5, 10**6)
    batch = pa.record_batch({"region": pa.array([5 << 42, 7 << 42], pa.int64()),
                             "words": [" ".join(own), " ".join(own[:2000] + own[:500])]})
    rows = [pa.Table.from_batches(repeats.region_windows(
        35, np.array([], np.uint64), 40, 4, now)(iter([batch]))) for now in range(4)]
    sizes = [sum(map(len, r["window"].to_pylist())) // 8 for r in rows]
    assert sum(sizes) == (3000 - 34) + (2500 - 34) - (500 - 34)
    assert max(sizes) < 0.4 * sum(sizes)
    found = pa.concat_tables([repeats.confirm(r.filter(pc.equal(r["bucket"], b)))
                              for r in rows for b in set(r["bucket"].to_pylist())])
    places = [(r["region"], r["place"] + k, tuple(r["shards"])) for r in found.to_pylist()
              for k in range(r["n"])]
    # Places of the first text, and all lie in both shards
    assert sorted(places) == [(5 << 42, k, (5, 7)) for k in range(2000 - 34)]


def test_windows_of_equal_first_hash_are_told_apart():
    rows = pa.table({
        "bucket": pa.array([0, 0], pa.int64()), "shard": pa.array([1, 2], pa.int64()),
        "window": [np.array([9, 9, 8], np.uint64).tobytes(), np.array([9], np.uint64).tobytes()],
        "other": [np.array([3, 4, 5], np.uint32).tobytes(), np.array([4], np.uint32).tobytes()],
        "twice": [np.packbits([0, 0, 1]).tobytes(), np.packbits([0]).tobytes()],
        "begin": [np.array([(1 << 42) + 6], np.int64).tobytes(),
                  np.array([2 << 42], np.int64).tobytes()],
        "n": [np.array([3], np.int32).tobytes(), np.array([1], np.int32).tobytes()]})
    assert repeats.confirm(rows).to_pylist() == [
        {"region": 1 << 42, "place": 7, "n": 2, "shards": [1, 2]}]


def test_repeats_of_nothing(no_docs):
    assert remove_repeats(no_docs).count() == 0


# -- packing ------------------------------------------------------------------------------

def test_pack_holds_every_id_once(edge_docs):
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    size = 512
    placed = pack(edge_docs, BPE, 2, size, with_ids=True).cache()
    pieces = collections.defaultdict(list)
    for r in placed.collect():
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    want = collections.Counter()
    for doc_id, text, *_ in edge_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        for at in range(0, len(ids), size):
            want[doc_id, len(ids), at, np.array(ids[at:at + size], "<u4").tobytes()] += 1
    assert want == collections.Counter(
        (*k, *p) for k, parts in pieces.items() for p in parts)
    bins = collections.defaultdict(list)
    for r in placed.collect():
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    assert {r.n_tokens * 4 == len(r.ids) for r in sequences(placed).collect()} == {True}


def test_added_tokens_are_read_as_the_tokenizer_reads_them():
    plain = Tokenizer.from_file(BPE)
    for text in ("a <|endoftext|> b", "x<|endoftext|>y <|startoftext|>", "<|EndOfText|> é",
                 "<| endoftext |>", "日<|endoftext|>本"):
        ids = np.frombuffer(token_bytes(text.encode(), BPE, 2), "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids + [2], text


def test_pack_of_nothing(no_docs):
    assert pack(no_docs, BPE, 2).count() == 0


def test_word_ids_stay_small_and_keep_frequent_words(monkeypatch):
    """Ids of all kinds of words equal the tokenizer's; a full cache does not forget the words
    in use, and holds no more than two generations."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    monkeypatch.setattr(packing, "CACHED_PIECES", 10)
    cache, whole, asked = packing.WordIds(BPE), Tokenizer.from_file(BPE), []
    of_word = cache.of_word
    monkeypatch.setattr(cache, "of_word", lambda w: asked.append(w) or of_word(w))
    odd = ["The", "the,", "Éclair.", "straße", "don't", "a1b2", "...", ",", "x,.", "µm", "ªº,",
           "日本語", "İstanbul.", "a\u00a0b", "\x1c", "<|endoftext|>", "x<|ENDOFTEXT|>,", "e\u0301."]
    for text in odd + [f"word{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(300)]:
        for word in ("often", text):
            got = np.frombuffer(cache[word.encode()], "<u4").tolist()
            assert got == whole.encode(word, add_special_tokens=False).ids, word
    assert len(cache) <= 40 and len(cache.older) <= 40 and len(cache.pieces) <= 10
    assert asked.count(b"often") == 1


def test_words_met_once_push_out_no_frequent_ones(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    cache, asked = packing.WordIds(BPE), collections.Counter()
    of_word = cache.of_word
    monkeypatch.setattr(cache, "of_word", lambda w: asked.update([w]) or of_word(w))
    often = [f"often{c}".encode() for c in "abcdefghij"]
    for word in often * 2 + [f"once{i}".encode() for i in range(500)] + often:
        cache[word]
    assert {asked[w] for w in often} == {1}
    assert len(cache.young) <= 40 and len(cache.older_young) <= 40


def test_forms_of_a_word_are_tokenized_once(monkeypatch):
    """Capitals, digits and marks beside a word ask the tokenizer for nothing new."""
    asked = collections.Counter()
    of_word = packing.WordIds.of_word
    monkeypatch.setattr(packing.WordIds, "of_word",
                        lambda self, w: asked.update([w]) or of_word(self, w))
    monkeypatch.setattr(packing, "word_ids", functools.lru_cache(packing.WordIds))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(
        get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["some Some SOME some, Some. (some) some-some some12 3some/", "\u00e9t\u00e9 \u00e9t\u00e9."]
    batch = pa.record_batch({"doc_id": [1, 2], "text": texts})
    out, = packing.cut(BPE, 2, 4096, True)(iter([batch]))
    whole = Tokenizer.from_file(BPE)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in out.column("ids").to_pylist()] == [
        whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert set(asked) == {w.encode() for w in [
        "some", ",", ".", "(", ")", "-", "/", "1", "2", "3", "\u00e9t\u00e9"]}
    assert set(asked.values()) == {1}


def test_separated_texts_have_the_same_ids():
    """Beside apostrophes, wide and combining characters, signs, odd blanks and added tokens."""
    parts = [*"abhsStTdHK019,.;-'\"(<|>", "'s", "'LL", "it's", *"\u00e9\u00c9\u00df\u00f1\u00d7\u00f7\u00ab\u00bb\u00aa\u00b2\u00b7\u00ad",
             *"\u00a0\u0085\u0097\u0331\u0301\u0308\u2019\u201c\u2014\u65e5\u0130\u03a3\u03c2\u212a\ufb01\u0663\u2009\U0001f642\U00010400\u200d\x1c\x00\x7f\n\t",
             " ", " ", " ", " ", "<|endoftext|>", "<|EndOfText|>"]
    rng, whole = random.Random(5), Tokenizer.from_file(BPE)
    texts = ["".join(rng.choices(rng.sample(parts, rng.randint(2, len(parts))),
                                 k=rng.choice([0, 1, 2, 3, 8, 40]))) for _ in range(4000)]
    data, offsets = packing.separated(*text_buffer(pa.array(texts)),
                                      packing.word_ids(BPE).added_bytes)
    for i, text in enumerate(texts):
        ids = np.frombuffer(token_bytes(
            data[offsets[i]:offsets[i + 1]].tobytes(), BPE, 2), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids + [2], text


def test_first_fit_is_first_fit():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 101, 300))[::-1]
    bins, offsets = first_fit(lengths, 100)
    free = []
    for n, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        fit = next((i for i, f in enumerate(free) if f >= n), None)
        if fit is None:
            free.append(100)
            fit = len(free) - 1
        assert (fit, 100 - free[fit]) == (b, o)
        free[fit] -= n


# -- token counts -------------------------------------------------------------------------

def test_token_counts_equal_the_tokenizer(edge_docs):
    tokenizer = Tokenizer(models.Unigram(read_vocabulary(PIECES), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    got = rows_of(token_counts(edge_docs, PIECES), "doc_id", "n_tokens")
    assert got == sorted(((r[0], len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids))
                          for r in edge_rows()), key=lambda r: tuple(key(v) for v in r))


@pytest.mark.parametrize("vocabulary", [
    [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0),
     ("ba", -2.0), ("aba", -3.0)],
    [("<unk>", 0.0), ("a", -1.5), ("▁a", -2.25), ("aa", -3.0), ("aaa", -4.5), ("▁", -0.75)]])
def test_ties_and_unknown_characters_follow_the_tokenizer(vocabulary):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    counter = Counter(vocabulary)
    for text in ("aba", "abab ab", "aaaaaaa", "a\nxxb  a", "", " ", "xyz a", "baab▁aa", "x"):
        assert counter.of_text(text) == len(
            tokenizer.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_nothing(no_docs):
    assert token_counts(no_docs, PIECES).count() == 0


# -- licenses -----------------------------------------------------------------------------

def scan(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in scan_licenses(docs).orderBy("doc_id").collect()]


def test_license_rules_take_the_longest_first(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the "
           "Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
           "and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:\nThe above copyright notice and this permission notice shall "
           "be included in all copies or substantial portions of the Software.")
    got = scan(spark, "Released under the MIT License. " + mit, mit,
               "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
               "This file is in the public domain. A license we do not know.", None, "")
    assert got == [("MIT", 3, 0, ""), ("MIT", 2, 0, ""), ("Apache-2.0", 2, 0, "<AllRights>"),
                   ("Public-Domain", 1, 1, ""), ("", 0, 0, ""), ("", 0, 0, "")]


APACHE = """\
   Copyright 2020 Some One

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
MIT = """\
MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD_HEAD = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
BSD_NAMES = """\
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
BSD_TAIL = """\
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ISC = """\
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
"""
GPL = """\
    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
MPL = """\
This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. Other words follow.
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n"


def commented(text, first, mark, last):
    return "\n".join([first, *(f"{mark} {x}".rstrip() for x in text.split("\n")), last])


def test_wrapped_notices_are_whole_sentences(spark):
    notices = [(APACHE, "Apache-2.0", 5, 1), (MIT, "MIT", 5, 1),
               (BSD_HEAD + BSD_TAIL, "BSD-2-Clause", 5, 0),
               (BSD_HEAD + BSD_NAMES + BSD_TAIL, "BSD-3-Clause", 6, 0), (ISC, "ISC", 2, 0),
               (GPL, "GPL-3.0-or-later", 5, 0), (MPL, "MPL-2.0", 1, 0),
               (UNLICENSE, "Unlicense", 1, 0)]
    expected = [(name, known, unknown, "") for _, name, known, unknown in notices]
    texts = [text for text, *_ in notices]
    assert scan(spark, *texts) == expected
    assert scan(spark, *[commented(t, "/*", " *", " */") for t in texts]) == expected
    assert scan(spark, *[commented(t, "#!/bin/sh", "#", "x = 1") for t in texts]) == expected
    assert scan(spark, *[commented(t, "", "--", "") for t in texts]) == expected
    assert scan(spark, *[t.replace("\n", "\r\n") for t in texts]) == expected


def test_spdx_tags(spark):
    got = scan(spark, "// SPDX-License-Identifier: MIT\nint x;",
               "/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) */",
               "# SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0",
               "<!-- SPDX-License-Identifier: Apache-2.0 AND LicenseRef-x -->")
    assert got == [("MIT", 1, 0, ""), ("GPL-2.0,BSD-3-Clause", 1, 0, ""),
                   ("GPL-2.0-or-later", 1, 0, ""), ("Apache-2.0", 0, 1, "")]


def test_lines_that_are_not_wrapped_stay_sentences(spark):
    got = scan(spark, "Some words\nAll rights reserved\nLicensed under the MIT License",
               "a line of some length that ends here\nfoo\nlicensed under the mit license",
               "Nothing in this long sentence says that the file would be\nin the public domain.")
    assert got == [("MIT", 2, 0, "<AllRights>"), ("MIT", 1, 0, ""), ("", 0, 1, "")]


def test_licenses_on_odd_rows(edge_docs, no_docs):
    got = {r.doc_id: r.licenses for r in scan_licenses(edge_docs).collect() if r.licenses}
    assert got == {8: "MIT,CC-BY-NC-4.0"}
    assert scan_licenses(edge_docs).count() == len(edge_rows())
    assert scan_licenses(no_docs).count() == 0


# -- quality ------------------------------------------------------------------------------

def plain_counts(text):
    w = WORD.findall(text or "")
    windows = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + s for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1
               for s in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_counts_on_odd_rows(spark, edge_docs):
    labels = spark.createDataFrame([(1, 1, "a"), (1, None, "a"), (None, 1, "a"), (3, 0, "a")],
                                   "doc_id long, quality int, n_words string")
    got = q.quality(edge_docs, labels)
    assert rows_of(got, "doc_id", *NAMES) == sorted(
        ((r[0], *plain_counts(r[1])) for r in edge_rows()),
        key=lambda r: tuple(key(v) for v in r))
    assert all(r.kept == (not r.base_failed) for r in got.collect())
    kept = q.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert kept.count() == got.where("kept").count()


def test_quality_of_nothing(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.quality(no_docs, labels).count() == 0
    assert q.keep_good(no_docs, labels).count() == 0


def binomial_upper(k, n, level):
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if q.at_most(k, n, mid) > level else (low, mid)
    return high


@pytest.mark.parametrize("k,n", [(0, 100), (0, 400), (3, 700), (10, 2000)])
def test_bounds_are_exact(k, n):
    assert q.upper_bound_holds(k, n, 0.02, 0.001) == (binomial_upper(k, n, 0.001) <= 0.02)
    assert q.at_most(n, n, 0.3) == pytest.approx(1.0)


def test_certified_cutoffs_reject_junk_and_limit_false_rejections(spark):
    good = [(i, " ".join(words(80, i)), "en", 1) for i in range(1500)]
    junk = [(2000 + i, " ".join(x + "###" for x in words(80, i)), "en", 0) for i in range(60)]
    few = [(3000 + i, " ".join(x + "###" for x in words(80, i)), "de", 0) for i in range(5)]
    docs = spark.createDataFrame([r[:3] for r in good + junk + few],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in good + junk],
                                   "doc_id long, quality int")
    kept = {r.doc_id for r in q.quality(docs, labels).where("kept").collect()}
    assert len(kept & set(range(1500))) >= 0.98 * 1500
    assert not kept & set(range(2000, 2060))
    # No labels in the stratum: nothing can be certified, nothing is rejected.
    assert kept >= set(range(3000, 3005))


# -- decontamination ----------------------------------------------------------------------

@pytest.mark.parametrize("width", [8, 9, 12, 13])
def test_masks_survive_all_allowed_substitutions(width):
    from itertools import combinations

    from contactloom.llm.decontaminate import allowed
    for wrong in combinations(range(width), allowed(width)):
        assert any(not set(wrong) & set(m) for m in masks(width))


def plain_hits(docs, items):
    def cut(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    out = set()
    for doc_id, text in docs:
        w = cut(text)
        for item_id, item in items:
            v = cut(item)
            width = min(len(v), 13)
            if width < 8:
                continue
            need = width - width * 2 // 13
            if any(sum(x == y for x, y in zip(w[i:i + width], v[j:j + width], strict=True))
                   >= need for i in range(len(w) - width + 1)
                   for j in range(len(v) - width + 1)):
                out.add((doc_id, item_id))
    return out


def test_passages_with_substitutions(spark):
    item = words(40, 50)
    short = words(9, 51)
    two = item[10:23]
    two[3], two[9] = "x1", "x2"
    three = item[10:23]
    three[1], three[5], three[9] = "x1", "x2", "x3"
    docs = [(1, " ".join(words(30, 60) + item)), (2, " ".join(words(30, 61) + two)),
            (3, " ".join(three + words(30, 62))), (4, " ".join(short).upper()), (5, None),
            (6, ""), (7, " ".join(item[:12])), (8, " ".join(["x"] * 500)),
            (9, " ".join(words(20, 63) + short[:5] + ["x9"] + short[6:]))]
    items = [(1, " ".join(item)), (2, ", ".join(short)), (3, "too short"), (4, None), (5, "")]
    got = passages(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == plain_hits(docs, items) == {
        (1, 1), (2, 1), (4, 2), (9, 2)}


def test_short_items_are_found_whole(spark):
    """Inside lines if they have enough characters, else only where they fill one."""
    items = [(1, "What is photosynthesis exactly?"), (2, "Who am I?"), (3, "yes"), (4, "?"),
             (5, "\u65e5\u672c\u306e\u9996\u90fd\u306f")]
    docs = [(1, "We ask: what is Photosynthesis, exactly? And then."), (2, "So who am I? Me."),
            (3, "First words.\r\n- Who am I?\nyes, that is all"), (4, "yes"),
            (5, "What is photosynthesis not exactly?"), (6, "?"), (7, None),
            (8, "\u56fd\u3001\u65e5\u672c\u306e\u9996\u90fd\u306f\u6771\u4eac"), (9, "a b\n\nyes\n")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in passages(docs_df, items_df).drop("text_key").collect()}
    assert got == {(1, 1, 1, 4, 2), (3, 2, 1, 3, 2), (4, 3, 1, 1, 0), (9, 3, 1, 1, 2),
                   (8, 5, 1, 6, 1)}
    left = {r.doc_id for r in without_passages(docs_df, items_df).collect()}
    assert left == {2, 5, 6, 7}


def test_scripts_without_blanks_have_a_token_for_each_character(spark):
    """A passage with other punctuation, other neighbours and one other character is found."""
    item = "\u5149\u5408\u6210\u306f\u690d\u7269\u304c\u5149\u3092\u4f7f\u3046\u904e\u7a0b\u3067\u3059"
    doc = f"\u6587{item[:5]}\u3001{item[5:9]}\u98df{item[10:]}\u3002 caf\u00e9"
    docs = spark.createDataFrame([(1, doc), (2, item[:6])], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [(r.doc_id, r.best, r.first_at) for r in passages(docs, bench).collect()] == [
        (1, 12, 1)]


def test_decontamination_on_odd_rows(spark, edge_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, " ".join(words(60, 3)), "a"), (1, " ".join(words(60, 3)), "b"), (None, None, "c")],
        "item_id long, text string, shard string")
    left = without_passages(edge_docs, bench)
    assert left.columns == edge_docs.columns
    assert {r.doc_id for r in edge_docs.collect()} - {r.doc_id for r in left.collect()} == {
        12, 13}
    assert left.count() == len(edge_rows()) - 2
    assert passages(no_docs, bench).count() == 0
    assert without_passages(edge_docs, bench.limit(0)).count() == len(edge_rows())


def test_large_benchmarks_are_shuffled_with_the_same_result(spark, edge_docs, monkeypatch):
    from contactloom.llm import decontaminate
    bench = spark.createDataFrame([(1, " ".join(words(60, 3)))], "item_id long, text string")
    want = rows_of(passages(edge_docs, bench), "doc_id", "item_id", "n_windows", "best")
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert rows_of(passages(edge_docs, bench), "doc_id", "item_id", "n_windows", "best") == want


# -- pipeline -----------------------------------------------------------------------------

def test_pipeline_stages_against_plain_versions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "substring_dedup",
                            "decontamination", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    docs = corpus_pipeline.written(stages["quality_rules"](spark, docs, sf), "t")
    want = {i for i, t in texts.items() if not plain_counts(t)[-1]}
    assert {r.doc_id for r in docs.collect()} == want  # too few labels to certify a cutoff

    docs = corpus_pipeline.written(stages["near_dedup"](spark, docs, sf), "t")
    want = {r[0] for r in plain_components(sorted((i, texts[i]) for i in want), 5, 80) if r[3]}
    assert {r.doc_id for r in docs.collect()} == want

    docs = corpus_pipeline.written(stages["substring_dedup"](spark, docs, sf), "t")
    order = sorted(want)
    left = {i: p for i, p in zip(order, plain_removal([texts[i] for i in order], 35),
                                 strict=True) if p[1] == 0 or p[1] < p[0]}
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: WORD.findall(r.text) for i, r in got.items()} == {
        i: p[3] for i, p in left.items()}
    assert all(r.n_chars == len(r.text) for i, r in got.items() if left[i][1])

    docs = corpus_pipeline.written(stages["decontamination"](spark, docs, sf), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet")
             .select("item_id", "text").collect()]
    leaks = {i for i, _ in plain_hits([(i, r.text) for i, r in got.items()], items)}
    assert {r.doc_id for r in docs.collect()} == set(got) - leaks

    packed = stages["packing"](spark, docs, sf)
    assert {r.doc_id for r in packed.collect()} == set(got) - leaks
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
