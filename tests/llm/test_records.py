"""WARC archives, exact search and secret scans against plain versions."""

import gzip
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest

from sluiceway.llm import guess_cost
from sluiceway.llm.guess_cost import GuessCost, joined, redacted, secrets_found
from sluiceway.llm.shared import fresh_folder
from sluiceway.llm.top_k import best_of_tile, products, top_k
from sluiceway.llm.warc import archive_round_trip, base32_sha1, normalise, read_records, write_archives

PAGES = "page_id bigint, url string, html string, digest string, payload string, revisit string, records string"


def pages(session, rows):
    return session.createDataFrame([(i, u, h, "x", "x", "x", "x") for i, u, h in rows], PAGES)


def test_archives_of_odd_pages(session, rows):
    long = "<p>é\r\n\r\nWARC/1.1</p>" * 60_000
    table = [
        (1, "http://a/", "same"), (2, None, "same"), (9, "http://a/\r\nX: y", "same"), (3, "http://b/", None), (4, "http://b/", ""),
        (None, "http://c/", "same"), (None, None, "alone"), (5, "http://d/", long), (6, "ü", "line\r\n\r\nline"), (7, "u", "twice"), (7, "u", "twice"),
    ]
    best = {}
    for i, _, h in table:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    expected = []
    for i, _, h in table:
        copy = (h or "") in best and i != best[h or ""]
        expected.append((i, len((h or "").encode()), base32_sha1((h or "").encode()), "revisit" if copy else "response", best[h or ""] if copy else None))
    found = archive_round_trip(pages(session, table).repartition(3)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(found) == sorted(expected, key=repr)
    assert rows(archive_round_trip(pages(session, []))) == []


def test_small_payloads_are_all_responses(session):
    folder = fresh_folder(session)
    archives = write_archives(pages(session, [(i, "u", "ab") for i in range(4)] + [(i, "u", "abc") for i in range(4, 8)]), folder, revisit_from=3)
    found = read_records(normalise(archives, folder + "/members"))
    assert {r["page_id"] for r in found.filter("record_type = 'revisit'").collect()} == {4, 5, 6}


def test_every_record_is_a_member_of_its_own_and_payloads_come_back(session):
    folder = fresh_folder(session)
    table = [(i, f"http://h/{i}", f"<html>{'ä' * i}</html>") for i in range(300)]
    archives = write_archives(pages(session, table).coalesce(1), folder, roll_bytes=20_000)
    assert archives.count() > 2
    for row in archives.collect():
        stream = zlib.decompressobj(31)
        stream.decompress(open(row["uri"].removeprefix("file:"), "rb").read())
        assert stream.eof and not stream.unused_data
    slices = normalise(archives, folder + "/members")
    for row in slices.collect():
        path = row["uri"].removeprefix("file:")
        data = open(path, "rb").read()
        for line in open(path + ".idx").read().splitlines():
            name, kind, offset, length = line.split("\t")
            member = gzip.decompress(data[int(offset) : int(offset) + int(length)])
            assert member.startswith(b"WARC/1.1\r\n") and name.encode() in member and kind == "response"
    found = {r["page_id"]: (r["target_uri"], bytes(r["payload"]).decode()) for r in read_records(slices, with_payload=True).collect()}
    assert found == {i: (u, h) for i, u, h in table}


VECTORS = "vec_id bigint, embedding array<float>, row bigint, dim string, shard string, parts string"


def vectors(session, table):
    return session.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in table], VECTORS)


def plain_top(table, k, every):
    sound = [(i, np.floor(np.array(v, np.float32).astype(float) * 256).astype(int)) for i, v in table if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = []
    for q, a in sound:
        if q % every == 0:
            scored = sorted((-int(a @ b), i) for i, b in sound if i != q and len(a) == len(b))
            found += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def test_top_k_of_odd_vectors(session, rows):
    draw = np.random.default_rng(2)
    table = [(i, draw.normal(size=6).astype(float).tolist()) for i in range(230)]
    table += [(1000 + i, [0.5] * 6) for i in range(60)]  # many ties
    table += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (None, [0.1] * 6), (350, [0.25] * 4), (351, [0.5] * 4), (352, [])]
    for cells in (6 * 40, 6 * 150, 1 << 22):
        assert rows(top_k(vectors(session, table), 5, 50, tile_cells=cells, fan_in=2)) == sorted(plain_top(table, 5, 50), key=repr)
    assert rows(top_k(vectors(session, table[:3]), 5, 1)) == plain_top(table[:3], 5, 1)
    assert rows(top_k(vectors(session, []))) == []
    assert rows(top_k(vectors(session, [(0, [1.0])]))) == []


def test_repeated_vectors_are_candidates_each(session):
    found = top_k(vectors(session, [(50, [1.0]), (3, [1.0]), (3, [1.0]), (4, [0.5])]), 3).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(3, 65536), (3, 65536), (4, 32768)]


def test_products_beyond_doubles_are_exact_and_bounded():
    wide = np.array([[2**53 + 1, 1]])
    assert products(wide, np.array([[1, 0]])).tolist() == [[2**53 + 1]]
    assert products(np.array([[2**62, 2**62]]), np.array([[2, 2], [-2, -4]])).tolist() == [[2**63 - 1, -(2**63)]]
    assert products(np.array([[2**62]]), np.array([[4], [-4]])).tolist() == [[2**63 - 1, -(2**63)]]


def test_a_tile_keeps_ties_to_the_left():
    scores = np.array([[3, 7, 7, 7, 1]])
    own = np.array([[False, True, False, False, False]])
    assert [x.tolist() for x in best_of_tile(scores, own, 2)] == [[0, 0], [2, 3]]


def plain_base(text):
    found = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, good in (("assign", assign, lambda m: len(m[2]) >= 6), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        found += [(m.start(), m.end(), kind) for m in re.finditer(pattern, text) if good(m)]
    return found


def test_base_patterns_are_leftmost_and_drop_short_ones():
    draw = random.Random(9)
    bits = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH", "0123456789ab", "deadbeef", "x", "é", "\n", "="]
    for _ in range(4000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(1, 14)))
        assert joined(guess_cost.base_spans(text)) == joined(plain_base(text)), text
    assert joined(guess_cost.base_spans("password: token: abcdefgh")) == ""


def plain_span(piece):
    """Guesses of one span, by its definition."""
    low, brute = piece.lower(), sum(guess_cost._character(c) for c in piece)
    found = [brute]
    for word, cased in ((low, 0.0), (low.translate(guess_cost.LOOK_ALIKE), math.log10(4))):
        if word in guess_cost.COMMON_WORDS and len(word) > 1:
            case = 0.0 if piece == low else math.log10(2 if piece[1:].islower() or piece.isupper() else 16)
            found.append(math.log10(guess_cost.COMMON_WORDS.index(word) + 2 - REPEATED[word]) + cased + case)
            break
    year, month, day, sign = "(19|20)[0-9]{2}", "(0[1-9]|1[0-2])", "(0[1-9]|[12][0-9]|3[01])", "[-/._]"
    if re.fullmatch(year, piece):
        found.append(math.log10(150))
    for a, c in ((year, day), (day, year)):
        if any(re.fullmatch(a + s + month + s + c, piece) for s in ("", "-", "/", "[.]", "_")):
            found.append(math.log10(365 * 150 * 3))
    for unit in range(1, 9):
        copies = len(piece) // unit
        if copies > 1 and piece == piece[:unit] * copies:
            found.append(sum(guess_cost._character(c) for c in piece[:unit]) + math.log10(copies))
    steps = [guess_cost._STEPS.get(pair) for pair in zip(low, low[1:])]
    if len(piece) >= 3 and None not in steps:
        turns = 1 + sum(a != b for a, b in zip(steps, steps[1:]))
        found.append(math.log10(47 * len(piece)) + turns * math.log10(4))
    return min(found)


#: How many ranks a word moves up because words before it are listed twice.
REPEATED = {w: i - len(set(guess_cost.COMMON_WORDS[:i])) for i, w in reversed(list(enumerate(guess_cost.COMMON_WORDS)))}


def plain_cost(value):
    """Least cost over every way to cut a value, with spans listed from their definitions."""
    best = [0.0]
    for end in range(1, len(value) + 1):
        best.append(min(best[s] + plain_span(value[s:end]) + (math.log10(2) if s else 0.0) for s in range(end)))
    return best[-1]


@pytest.mark.parametrize(
    "value",
    ["password", "Passw0rd1", "qwertz99", "aaaa2001", "k9#Xq", "abcabcabc", "1987-05-12", "zxcvbnAA", "x", "", "passwordfghjkl", "abcabc99",
     "asdfghjkl;lkjhgf", "01012001012001", "20010102200", "qwqwqwqwasas", "12/12-2012", "٣٣٢٠٠١"],
)
def test_guess_cost_is_the_least_over_all_cuts(value):
    assert GuessCost()(value) == pytest.approx(plain_cost(value))


def test_guess_cost_of_random_values():
    draw, cost = random.Random(3), GuessCost()
    bits = ["pass", "word", "qwer", "asdf", "fghj", "123", "321", "a", "ab", "ab", "19", "99", "01", "-", "0", "x", "Admin", "é", "4", "zx"]
    for _ in range(1500):
        value = "".join(draw.choice(bits) for _ in range(draw.randint(1, 7)))
        assert cost(value) == pytest.approx(plain_cost(value)), value
    for letters in ("ab", "aab", "qwe", "12"):
        for _ in range(150):
            value = "".join(draw.choice(letters) for _ in range(draw.randint(1, 26)))
            assert cost(value) == pytest.approx(plain_cost(value)), value


def test_parts_of_walks_and_two_copies_are_cheap():
    cost = GuessCost()
    assert cost("passwordfghjkl") < 8 and cost("abcabc99") < 8


@pytest.mark.parametrize("unit", ["a", "ab", "qwerty", "qw", "12345678", "asdfghjkl"])
def test_long_values_take_time_in_proportion(unit):
    cost, value = GuessCost(), unit * (60_000 // len(unit))
    begin = time.process_time()
    cost(value)
    assert time.process_time() - begin < 20


def test_guess_costs_are_in_a_sensible_order():
    cost = GuessCost()
    weak = ["password", "Passw0rd", "changeme", "qwerty123", "aaaaaaaaaaaa", "2021-05-06", "abcdefgh1", "letmein2020", "<required>", "xxxxxxxx"]
    strong = ["kX9#mQ2$vL", "b7db7aa4a5fcc78305", "correcthorsebattery", "tr0ub4dor&3zQ"]
    assert max(map(cost, weak)) < 8 <= min(map(cost, strong))


def test_secrets_of_odd_rows(docs, rows):
    key = "AKIA" + "Z9" * 8
    table = [
        (1, None), (2, ""), (3, f"é password = 'kX9mQ2vLw1' and {key}"), (4, "pwd => hunter2x9Q#"), (5, "password: changeme"),
        (6, "db://me:k8#Lq0vXz@host"), (None, "token=abcdef1234567890"), (7, "a" * 200_000 + " secret: " + "0f" * 16), (7, "plain"), (7, "plain"),
    ]
    expected = []
    for d, t in table:
        base = plain_base(t or "")
        counts = [sum(k == kind for _, _, k in base) for kind in ("assign", "access", "hex")]
        expected.append((d, *counts, hashlib.sha256(joined(base).encode()).hexdigest()))
    found = secrets_found(docs(table))
    assert rows(found.drop("spans")) == sorted(expected, key=repr)
    spans = {(r["doc_id"], r["spans"]) for r in found.collect()}
    assert {s for d, s in spans if d == 4} == {"guess:7:18"}
    assert {s for d, s in spans if d == 5} == {"assign:0:18"}
    assert {s for d, s in spans if d == 6} == {"guess:8:17"}
    assert rows(secrets_found(docs([]))) == []


def test_redaction_keeps_rows_and_columns(docs):
    table = docs([(1, "x password=abc123XY and token=Zq8vLw1kXm9!"), (2, "clean"), (3, None)])
    found = {r["doc_id"]: r for r in redacted(table).collect()}
    assert redacted(table).columns == table.columns
    assert found[1]["text"] == "x [secret] and [secret]" and found[1]["n_chars"] == len(found[1]["text"])
    assert found[2]["text"] == "clean" and found[3]["text"] is None
