"""Token ids, id files, packing and counts against the tokenizers library itself."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluiceway.llm.elias_fano import EliasFano, TokenFile, read_token_files, token_file_round_trip, write_token_files
from sluiceway.llm.packing import best_fit, packed_sequences
from sluiceway.llm.rank_merges import MergeTable, TokenCounter, token_counts
from sluiceway.llm.shared import fresh_folder
from sluiceway.llm.tokens import Encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    "a", "B", "é", "é", " ", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "\x01", "'s", "!", "12", ".", ",", "the", "ing",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "İ", "​", "᠎", "　", "漢", "ß", "́", "  ", "\n\n", "한", "ﬁ", "K",
]
ODD = [(1, None), (2, ""), (3, "The end.\n\nA new  line, of words' worth"), (4, "x" * 30_000), (5, "the cat " * 3000), (3, "again"), (None, "no id"), (7, "same"), (7, "same")]


def strange_texts(n=3000):
    draw = random.Random(5)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 16))) for _ in range(n)] + ["a" * 4000, "ab" * 900, "!" * 300]


@pytest.mark.parametrize(("path", "blanks"), [(BYTES, True), (WORDS, False)])
def test_encoder_gives_the_library_ids(path, blanks):
    texts, library = strange_texts(), Tokenizer.from_file(path)
    code = Encoder(path, blanks, cache_units=500)
    ids, sizes = [], []
    for i in range(0, len(texts), 100):
        found, counts = code.encode(texts[i : i + 100])
        ids.append(found)
        sizes.append(counts)
    parts = np.split(np.concatenate(ids), np.cumsum(np.concatenate(sizes))[:-1])
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in parts] == expected


def test_counts_are_the_library_counts():
    texts = strange_texts()
    counter = TokenCounter(WORDS, cache_words=500)
    found = np.concatenate([counter.count(texts[i : i + 100]) for i in range(0, len(texts), 100)])
    assert found.tolist() == [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


def test_merges_that_are_out_of_order_go_one_by_one(tmp_path):
    """A token made late and used early: merging all its places at once would be wrong."""
    import json

    table = MergeTable(WORDS)
    spec = json.loads(open(WORDS, encoding="utf-8").read())
    letters = {table_key: i for i, table_key in enumerate(["a", "b", "c"])}
    vocab = dict(spec["model"]["vocab"])
    base = {k: v for k, v in vocab.items() if len(k) == 1 or (len(k) == 5 and k.endswith("</w>"))}
    made = ["bc", "abc", "abca", "ab"]
    base |= {m: 60_000 + i for i, m in enumerate(made)}
    spec["model"]["vocab"], spec["model"]["merges"] = base, ["b c", "a bc", "abc a", "a b"]
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(spec))
    assert letters and table.in_order.all()
    odd, library = TokenCounter(str(path)), Tokenizer.from_file(str(path))
    texts = ["".join(p) for n in range(1, 8) for p in itertools.product("abc", repeat=n)]
    assert odd.count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_of_odd_rows(docs, rows):
    library = Tokenizer.from_file(WORDS)
    n = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, (_, t) in enumerate(ODD)}
    expected = sorted([(d, len((t or "").encode()), n[i], n[i] > 2048) for i, (d, t) in enumerate(ODD)], key=repr)
    assert rows(token_counts(docs(ODD), WORDS)) == expected
    assert rows(token_counts(docs([]), WORDS)) == []


@pytest.mark.parametrize("top", [1, 3, 1000, 2**40, 2**63])
def test_elias_fano_round_trip(top):
    draw = np.random.default_rng(top)
    for n in (0, 1, 2, 255, 256, 257, 2000):
        values = np.sort(draw.integers(0, top, n, dtype=np.uint64))
        code = EliasFano.encode(values)
        assert [v for run in code.decode(300) for v in run.tolist()] == values.tolist()
        for start, stop in draw.integers(-3, n + 3, (20, 2)):
            assert code.run(int(start), int(stop)).tolist() == values[max(0, start) : max(0, stop)].tolist()
        assert [code.select(i) for i in range(0, n, 7)] == values[::7].tolist()
        if n == 2000:
            bits = 8 * (len(code.low) + len(code.high) + 4 * len(code.samples))
            assert bits <= n * (2.2 + max(0, np.log2(max(1, top / n))) + 1)
    with pytest.raises(IndexError):
        code.select(2000)


def test_token_files_of_odd_rows(session, docs, rows):
    library = Tokenizer.from_file(BYTES)
    table = [(d, t) for d, t in ODD if d != 3] + [(3, "one of its id"), (-5, "below zero"), (2**62, "far away")]
    expected, at = [], 0
    for d, t in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert rows(token_file_round_trip(docs(table), BYTES)) == sorted(expected, key=repr)
    assert rows(token_file_round_trip(docs([]), BYTES)) == []


def test_rows_of_one_doc_id_stand_in_one_order_and_spread_over_files(session, docs):
    draw = np.random.default_rng(1)
    table = [(7 if i % 3 else None, f"text {i} " * int(draw.integers(1, 9))) for i in range(900)]
    runs, name = [], "spark.sql.adaptive.coalescePartitions.enabled"
    session.conf.set(name, "false")
    try:
        for parts in (3, 11):
            manifest = write_token_files(docs(table).repartition(parts), fresh_folder(session), BYTES)
            assert manifest.count() > 3
            runs.append(sorted(map(str, read_token_files(manifest).collect())))
    finally:
        session.conf.unset(name)
    assert runs[0] == runs[1]


def test_any_document_of_a_token_file_can_be_read_alone(session, docs):
    table = [(i, f"document number {i} " * (i % 7)) for i in range(600)]
    manifest = write_token_files(docs(table), fresh_folder(session), BYTES)
    library, seen = Tokenizer.from_file(BYTES), 0
    for row in manifest.collect():
        file = TokenFile(row["uri"])
        names = file.names(0, file.n_docs)
        for i in range(0, file.n_docs, 13):
            assert file.document(i).tolist() == [*library.encode(table[names[i]][1], add_special_tokens=False).ids, 0]
            seen += 1
        file.close()
    assert seen > 40
    assert read_token_files(manifest).count() == 600


def test_best_fit_fills_the_fullest_bin():
    bins, offsets, fills = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fills.tolist() == [10, 10]
    assert bins.tolist() == [0, 1, 0, 1, 1]
    assert offsets.tolist() == [0, 0, 6, 5, 8]


def test_packing_is_whole_gapless_and_tight(session, docs, rows):
    draw = random.Random(3)
    table = [*ODD, *((100 + i, "the cat sat " * draw.randint(0, 60)) for i in range(400))]
    found = packed_sequences(docs(table).repartition(7), WORDS, capacity=128, slack=2, fan_in=2).toPandas()
    library = Tokenizer.from_file(WORDS)
    pieces = []
    for d, t in table:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        pieces += [(d, k, s, len(ids[s : s + 128]), zlib.crc32(ids[s : s + 128].tobytes())) for k, s in enumerate(range(0, len(ids), 128))]
    got = [(None if np.isnan(r[0]) else int(r[0]), *map(int, r[1:])) for r in found[["doc_id", "piece", "start", "length", "ids_crc32"]].values]
    assert sorted(got, key=repr) == sorted(pieces, key=repr)
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        ends = sequence["offset"] + sequence["length"]
        assert sequence["offset"].tolist() == [0, *ends.tolist()[:-1]]
        assert ends.max() <= 128
    at_once = len(best_fit(np.array([p[3] for p in pieces]), 128)[2])
    assert found["sequence_id"].nunique() <= at_once + 7  # one for each of the seven partitions
    assert rows(packed_sequences(docs([]), WORDS)) == []


def test_packing_that_cannot_merge_keeps_all(session, docs):
    """Every bin is underfull and no two fit together: nodes pass on few bins, and no piece is lost."""
    found = packed_sequences(docs([(i, "cat " * 79) for i in range(300)]).repartition(9), WORDS, capacity=128, fan_in=2, carry=3)
    assert found.selectExpr("count(*)", "count(DISTINCT sequence_id)", "max(offset)").first() == (300, 300, 0)
