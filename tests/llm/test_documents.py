"""Language, near-duplicates, repeated passages, benchmark copies and the whole pipeline against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sluiceway.llm import super_kmers
from sluiceway.llm.alignment import PATTERNS, _passes, best_alignments, contaminated
from sluiceway.llm.darts import components, near_duplicates, rarest, sharing_rare_units, shingles, signatures, similarity
from sluiceway.llm.guess_cost import GuessCost, base_spans, guess_spans, ordered
from sluiceway.llm.langid import Presence, fit, identified, with_language
from sluiceway.llm.queries import table
from sluiceway.llm.shingles import WordHashes, normal_words
from sluiceway.llm.super_kmers import sliding_least, without_repeats
from tests.conftest import SMALL


def prose(draw, n, words=400):
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


# Language


def test_held_out_accuracy(session):
    docs = table(session, "/root/testdata/sf0.01", "documents")
    found = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(found) > 200
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all()


def test_held_out_rows_follow_the_checksum_and_are_never_learnt(session):
    docs = table(session, SMALL, "documents")
    found = {r["doc_id"]: r for r in identified(docs).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    lied = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) AS lang")
    assert {i: r["lang_pred"] for i, r in found.items()} == {r["doc_id"]: r["lang_pred"] for r in identified(lied).collect()}


def test_language_of_odd_rows(docs, rows):
    odd = [(1, None), (2, ""), (3, "12 + 34 !"), (4, "the cat"), (4, "the cat"), (None, "no id"), (5, "the " * 400_000)]
    found = identified(docs(odd)).collect()
    assert Counter((r["doc_id"], r["lang_pred"]) for r in found) == Counter(
        [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "en"), (5, "en")]
    )
    assert {r["score"] for r in found if r["lang_pred"] == "und"} == {0.0}
    assert rows(identified(docs([]))) == []
    nothing = docs(odd).drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in identified(nothing).collect()} == {"und"}
    assert with_language(nothing, 0.25).count() == 4
    kept = with_language(docs(odd), 0.25)
    assert kept.columns == docs(odd).columns and kept.count() == 4


def test_the_pipeline_drops_languages_that_were_not_learnt(session):
    known = table(session, "/root/testdata/sf0.01", "documents")
    foreign = [
        "В начале было слово и слово было у бога и так далее по тексту",
        "Στην αρχή ήταν ο λόγος και ο λόγος ήταν προς τον θεό",
        "今天天气很好我们一起去公园散步吧然后去吃饭",
        "Na początku było słowo a słowo było u Boga i bogiem było słowo wszystko przez nie się stało",
        "Alussa oli sana ja sana oli jumalan luona ja sana oli jumala kaikki on saanut syntynsä",
        "nel principio era il verbo e il verbo era presso dio e il verbo era dio",
    ]
    rows = [(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(foreign)]
    whole = known.unionByName(session.createDataFrame(rows, known.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(session, whole, SMALL).collect()}
    assert kept == {r["doc_id"] for r in known.collect() if any(map(str.isalpha, r["text"] or ""))}


def test_junk_among_the_labelled_rows_moves_no_limit(session):
    """Whether a text stays does not depend on what else is held out."""
    known = table(session, "/root/testdata/sf0.01", "documents")
    held_out = [i for i in range(10**9, 10**9 + 400) if zlib.crc32(str(i).encode()) % 4 == 2]
    foreign = "Alussa oli sana ja sana oli jumalan luona ja sana oli jumala kaikki on saanut syntynsä"
    junk = [(i, " ".join(chr(0x4E00 + (i * 37 + j) % 9000) for j in range(60)), "en", "s", 119) for i in held_out[:60]]
    extra = [(7 * 10**8 + 1, foreign, None, "s", len(foreign))]
    for rows in (extra, extra + junk):
        kept = corpus_pipeline.language_id(session, known.unionByName(session.createDataFrame(rows, known.schema)), SMALL)
        assert kept.filter("doc_id >= 700000000").count() == 0


def plain_decisions(texts, labels, asked, ridge):
    """Kernel ridge regression on the presence kernel of sets of n-grams, no hashes and no landmarks."""
    grams = lambda t: {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    sets, others = [grams(t) for t in texts], [grams(t) for t in asked]
    kernel = lambda xs, ys: np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in ys] for a in xs])
    target = np.array([[1.0 if own == c else -1.0 for c in sorted(set(labels))] for own in labels])
    return kernel(others, sets) @ np.linalg.solve(kernel(sets, sets) + ridge * len(texts) * np.eye(len(texts)), target)


def test_decisions_against_the_plain_kernel(session):
    found = table(session, SMALL, "documents").filter("lang IS NOT NULL AND length(text) > 20").orderBy("doc_id").limit(120).collect()
    texts, labels = [r["text"] for r in found], [r["lang"] for r in found]
    presence = Presence(3)
    held = [presence.held(t) for t in texts[:80]]
    expected = plain_decisions(texts[:80], labels[:80], texts[80:], 1e-2)
    whole = fit(held, labels[:80], 80, 400, 1e-2, 3).decisions(texts[80:], presence)[0]
    assert np.abs(whole - expected).max() < 0.05
    few = fit(held, labels[:80], 10, 400, 1e-2, 3)
    assert few.landmarks.shape[1] <= 10 * len(few.languages)
    assert (few.decisions(texts[80:], presence)[0].argmax(1) == expected.argmax(1)).mean() > 0.95
    assert fit(held, labels[:80], 10, 3, 1e-2, 3).landmarks.shape[1] <= 3


# Near-duplicates


def plain_classes(texts, threshold=0.8):
    hashes, units = WordHashes(), {}
    for i, t in texts:
        units[i] = shingles(hashes.of(normal_words(t or "")), 5)
    parent = {i: i for i in units}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    names = sorted(units)
    for p, a in enumerate(names):
        for b in names[p + 1 :]:
            if len(units[a]) and similarity(units[a], units[b]) >= threshold:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in names}


def near_copies(draw):
    """Chains whose ends differ, a large group of edits of one text, exact copies, and texts that only share a passage."""
    found, base = [], prose(draw, 200).split()
    for _ in range(40):
        edited = list(base)
        for at in draw.sample(range(200), 2):
            edited[at] = f"e{draw.randrange(10**6)}"
        found.append(" ".join(edited))
    chain = prose(draw, 300).split()
    for step in range(12):
        chain = [*chain[10:], *(f"c{step}x{j}" for j in range(10))]
        found.append(" ".join(chain))
    passage = prose(draw, 60)
    found += [f"{prose(draw, 60)} {passage} {prose(draw, 60)}" for _ in range(30)]
    return found + [found[0]] * 25 + ["one two", "one two", "One, two!", "alone here"]


def test_classes_are_the_components_of_similar_pairs(docs):
    draw = random.Random(4)
    texts = list(enumerate(near_copies(draw)))
    draw.shuffle(texts)
    found = near_duplicates(docs(texts).repartition(5))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == plain_classes(texts)


def test_similar_sets_share_one_of_their_rarest_units():
    draw = np.random.default_rng(5)
    met = 0
    for _ in range(2000):
        a = np.unique(draw.integers(0, 60, draw.integers(1, 60))).astype(np.uint64)
        b = np.setxor1d(a, draw.integers(0, 60, draw.integers(0, 12)).astype(np.uint64))
        common = np.unique(draw.integers(0, 60, 20)).astype(np.uint64)
        counts = draw.integers(2, 5, len(common))
        if len(b) and similarity(a, b) >= 0.8:
            met += 1
            assert len(np.intersect1d(rarest(a, common, counts, 0.8), rarest(b, common, counts, 0.8)))
    assert met > 500


def test_pages_of_one_template_below_the_threshold_do_not_meet(session):
    """However many pages share two thirds of their words, those that reach the tiles are the near copies among them."""
    draw, hashes = random.Random(2), WordHashes()
    template = prose(draw, 80)
    for n in (500, 5000):
        texts = [f"{template} {' '.join(f'o{draw.randrange(10**9)}' for _ in range(40))}" for _ in range(n)]
        texts += [texts[3] + " end", "start " + texts[7]]
        sets = [shingles(hashes.of(normal_words(t)), 5) for t in texts]
        assert 0.4 < similarity(sets[0], sets[1]) < 0.6
        rows = [(0, i, i, u.tobytes()) for i, u in enumerate(sets)]
        group = session.createDataFrame(rows, "main bigint, node bigint, root bigint, units binary")
        assert sorted(r["node"] for r in sharing_rare_units(group, 0.8).collect()) == [3, 7, n, n + 1]


def test_classes_within_a_template(docs):
    """Links among pages of a template, of similarities on both sides of the threshold."""
    draw = random.Random(21)
    template, texts = prose(draw, 120), []
    for own in (6, 12, 40, 60):
        texts += [f"{template} {' '.join(f'o{draw.randrange(10**9)}' for _ in range(own))}" for _ in range(25)]
    texts += [f"{t} {prose(draw, 4)}" for t in texts[60:90]]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    found = near_duplicates(docs(rows).repartition(4))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == plain_classes(rows)


def test_rows_that_share_a_doc_id_lose_no_link(docs):
    draw = random.Random(9)
    a, b, c, d = (prose(draw, 120) for _ in range(4))
    rows = [(7, a), (7, b), (8, a + " x"), (9, b + " y"), (10, c), (3, d), (11, d), (11, c + " z"), (12, prose(draw, 50)), (12, prose(draw, 50))]
    for _ in range(3):
        draw.shuffle(rows)
        found = {(r["doc_id"], r["class_id"]) for r in near_duplicates(docs(rows).repartition(3)).collect()}
        assert found == {(7, 7), (8, 7), (9, 7), (10, 3), (3, 3), (11, 3), (12, 12)}


def test_stages_lose_no_row_on_shared_or_missing_doc_ids(session, docs):
    item = table(session, SMALL, "benchmark").first()["text"]
    draw = random.Random(3)
    clean = [prose(draw, 80) for _ in range(6)]
    rows = [(None, item), (None, clean[0]), (None, clean[1]), (5, item), (5, clean[2]), (6, clean[3]), (6, clean[3]), (None, None), (6, clean[4])]
    kept = corpus_pipeline.decontaminate(session, docs(rows), SMALL)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for r in rows if r[1] != item)
    rows = [(1, clean[0]), (1, clean[1]), (1, clean[1]), (2, clean[0] + " end"), (3, clean[5]), (None, clean[0]), (None, clean[0])]
    kept = corpus_pipeline.near_dedup(session, docs(rows), SMALL)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([rows[0], rows[1], rows[4], rows[5], rows[6]])


def test_near_duplicates_of_odd_rows(docs, rows):
    long = " ".join(f"v{i % 5000}" for i in range(60_000))
    odd = [(1, None), (2, ""), (3, "!!"), (4, "same words here"), (9, "Same words, here"), (5, long), (6, long + " end"), (None, "same words here"), (7, "row"), (7, "row")]
    assert rows(near_duplicates(docs(odd)), "doc_id", "class_id") == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (9, 4), (5, 5), (6, 5), (None, None), (7, 7), (7, 7)], key=repr
    )
    assert rows(near_duplicates(docs([]))) == []


def test_signatures_estimate_weighted_similarity():
    draw, hashes = random.Random(1), WordHashes()
    words = [f"w{draw.randrange(30)}" for _ in range(400)]
    other = words[:320] + [f"x{i}" for i in range(80)]
    a, b = (shingles(hashes.of(w), 1) for w in (words, other))
    pair = signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 4096) & np.uint64(2**32 - 1)
    weights = [Counter(words), Counter(other)]
    exact = sum((weights[0] & weights[1]).values()) / sum((weights[0] | weights[1]).values())
    assert similarity(a, b) == pytest.approx(exact)
    assert (pair[0] == pair[1]).mean() == pytest.approx(exact, abs=0.03)
    alone = signatures(a, np.array([len(a)]), 4096) & np.uint64(2**32 - 1)
    assert (alone[0] == pair[0]).all()


def test_components_of_a_long_chain(session):
    links = session.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "left bigint, right bigint")
    nodes = session.createDataFrame([(i,) for i in range(61)] + [(100,), (200,), (300,)], "node bigint")
    found = {r["node"]: r["root"] for r in components(links, nodes).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 300}


# Repeated passages


def plain_repeats(texts, size):
    words = [(t or "").encode().split() for _, t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    found = []
    for (d, _), w in zip(texts, words, strict=True):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        found.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(found, key=repr)


@pytest.mark.parametrize("hot", [super_kmers.HOT, 2])
def test_repeats_against_all_windows(docs, rows, hot, monkeypatch):
    """Also with every repeated minimiser hot, and with a bitmap so small that it lets almost all pass."""
    monkeypatch.setattr(super_kmers, "HOT", hot)
    draw = random.Random(8)
    line, passage = prose(draw, 9), prose(draw, 50)
    texts = [(i, f"{prose(draw, draw.randint(0, 60))} {passage if i % 3 == 0 else line} {prose(draw, draw.randint(0, 60))}") for i in range(60)]
    texts += [(70, "x " * 90), (71, (prose(draw, 5) + " ") * 20), (72, None), (73, ""), (None, passage), (74, passage), (74, passage), (75, " \t\x0b".join("a b c".split()))]
    texts += [(80, "uno due\x1ctre " * 30), (81, prose(draw, 20, 2)), (82, " ".join(f"v{i}" for i in range(50_000)))]
    for size, bits in ((35, 1 << 26), (12, 1 << 15)):
        assert rows(without_repeats(docs(texts).repartition(4), size=size, filter_bits=bits)) == plain_repeats(texts, size)


def test_repeats_of_nothing(docs, rows):
    assert rows(without_repeats(docs([]))) == []
    assert rows(without_repeats(docs([(1, None), (2, "a b")]))) == plain_repeats([(1, None), (2, "a b")], 35)


@pytest.mark.parametrize("width", range(1, 9))
def test_sliding_least(width):
    values = np.random.default_rng(width).integers(0, 99, 20).astype(np.uint64)
    assert sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(21 - width)]
    assert sliding_least(values[: width - 1], width).tolist() == []


# Benchmark copies


def plain_alignment(a, b):
    table, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignments_of_many_pairs_at_once():
    draw = random.Random(6)
    pairs = [([draw.randrange(5) for _ in range(draw.randint(0, 12))], [draw.randrange(5) for _ in range(draw.randint(0, 15))]) for _ in range(200)]
    found = best_alignments([np.array(a, np.int64) for a, _ in pairs], [np.array(b, np.int64) for _, b in pairs])[0]
    assert found.tolist() == [plain_alignment(a, b) for a, b in pairs]


def plain_seeds(words):
    return {(p, tuple(words[j + at] for at in p)) for p in PATTERNS for j in range(len(words) - p[-1])}


def items(session, texts):
    return session.createDataFrame([(i, t, "x") for i, t in texts], "item_id bigint, text string, doc_id string")


def test_exact_edited_and_absent_items(session, docs, rows):
    draw = random.Random(2)
    tests = [(i, " ".join(f"t{i}x{j}" if j % 3 else f"w{draw.randrange(400)}" for j in range(30))) for i in range(8)]
    edited = tests[2][1].split()
    for at in range(0, 30, 7):
        edited[at] = "changed"
    del edited[12]
    texts = [(i, prose(draw, 80)) for i in range(30)]
    texts += [(100 + i, f"{prose(draw, 40)} {tests[0][1].upper()}! {prose(draw, 40)}") for i in range(300)]  # one item in most documents
    texts += [(500, f"{prose(draw, 20)} {' '.join(edited)} {prose(draw, 20)}"), (501, tests[3][1].replace(" ", ", ")), (502, " ".join(tests[4][1].split()[:8]))]
    texts += [(503, "tiny item"), (None, tests[5][1]), (504, None), (505, ""), (506, tests[6][1]), (506, tests[6][1]), (507, prose(draw, 9000) + " " + tests[7][1])]
    asked = items(session, [*tests, (20, "tiny item"), (21, None), (22, ""), (None, "no id here at all"), (0, tests[0][1])])
    for at_once in (1_000_000, 200):
        found = contaminated(docs(texts).repartition(4), asked, seeds_at_once=at_once)
        assert rows(found, "doc_id", "item_id") == sorted(
            [*((100 + i, 0) for i in range(300)), (500, 2), (501, 3), (503, 20), (None, 5), (506, 6), (507, 7)], key=repr
        )
    ends = {r["doc_id"]: (r["score"], r["word_end"]) for r in found.collect()}
    rarest = {r["doc_id"]: r["rarest"] for r in found.collect()}
    assert rarest[100] == rarest[399] == 300 and rarest[501] == rarest[507] == 1 and rarest[506] == 2
    assert ends[501] == (1.0, 30) and ends[507] == (1.0, 9030) and ends[500][0] < 1
    assert rows(contaminated(docs([]), asked)) == []
    assert rows(contaminated(docs(texts), items(session, []))) == []


@pytest.mark.parametrize("at_once", [1_000_000, 40])
def test_half_and_edited_copies_of_a_hot_item(session, docs, rows, at_once):
    draw = random.Random(9)
    item = [f"t{j}" if j % 3 else f"w{draw.randrange(40)}" for j in range(40)]
    texts = [(i, f"{prose(draw, 5)} {' '.join(item[:21])} {prose(draw, 5)}") for i in range(150)]
    texts += [(200 + i, " ".join(item)) for i in range(20)]
    for i in range(120):
        words = [f"w{draw.randrange(40)}" if draw.random() < 0.22 else w for w in item]
        texts.append((300 + i, f"{prose(draw, 6, 40)} {' '.join(words)} {prose(draw, 6, 40)}"))
    texts += [(500 + i, f"{prose(draw, 9, 40)} {' '.join(item[:draw.randint(4, 19)])} {prose(draw, 9, 40)}") for i in range(120)]
    expected = []
    for i, t in texts:
        words = t.split()
        if plain_seeds(words) & plain_seeds(item) and (score := plain_alignment(item, words)) >= 40:
            expected.append((i, 0, score / 80))
    found = contaminated(docs(texts).repartition(3), items(session, [(0, " ".join(item)), (1, prose(draw, 30, 40))]), seeds_at_once=at_once)
    assert rows(found, "doc_id", "item_id", "score") == sorted(expected, key=repr)
    assert {*range(150), *range(200, 220)} < {i for i, *_ in expected} and sum(300 <= i < 500 for i, *_ in expected) > 60


def test_edited_copies_are_found_wherever_their_score_is_reached(session, docs):
    """Copies with every n-th word replaced, and with random shares of words replaced, dropped or doubled."""
    draw = random.Random(12)
    wanted = {i: [f"t{i}x{j}" for j in range(draw.randint(15, 45))] for i in range(6)}
    texts = []
    for i, item in wanted.items():
        for step in (3, 4, 5):
            for first in range(step):
                texts.append([f"e{draw.randrange(10**6)}" if j % step == first else w for j, w in enumerate(item)])
        for share in (0.1, 0.2, 0.3):
            for _ in range(10):
                kinds = [draw.choice("rrdi") if draw.random() < share else "" for _ in item]
                texts.append([x for w, k in zip(item, kinds, strict=True) for x in {"": [w], "r": ["new"], "d": [], "i": [w, w]}[k]])
    rows = [(n, f"{prose(draw, 20)} {' '.join(t)} {prose(draw, 20)}") for n, t in enumerate(texts)]
    reached = {(n, i): s / len(item) / 2 for n, t in rows for i, item in wanted.items() if (s := plain_alignment(item, t.split())) >= len(item)}
    found = contaminated(docs(rows).repartition(3), items(session, [(i, " ".join(t)) for i, t in wanted.items()]))
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()} == pytest.approx(reached)
    assert len(reached) > 200


def test_passes_split_a_seed_that_many_items_share(session):
    chosen = session.range(400).selectExpr("id AS item_id", "7L AS seed", "0 AS place")
    sizes = [part.count() for part in _passes(chosen, "item_id", 100)]
    assert sum(sizes) == 400 and max(sizes) < 200


# The pipeline


def test_pipeline_against_plain_stages(session):
    whole = table(session, SMALL, "documents")
    rows = {r["doc_id"]: r["text"] for r in whole.collect()}
    languages = {r["doc_id"] for r in with_language(whole, 0.25).collect()}
    assert {i for i, t in rows.items() if any(map(str.isalpha, t or ""))} == languages
    classes = plain_classes([(i, rows[i]) for i in sorted(languages)])
    kept = {i for i, c in classes.items() if i == c}
    wanted = [normal_words(r["text"]) for r in table(session, SMALL, "benchmark").collect()]
    runs = defaultdict(set)
    for k, w in enumerate(wanted):
        for seed in plain_seeds(w):
            runs[seed].add(k)
    cost, expected, library = GuessCost(), [], Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i in sorted(kept):
        words = normal_words(rows[i])
        near = set().union(*(runs.get(seed, set()) for seed in plain_seeds(words)))
        if any(plain_alignment(wanted[k], words) >= len(wanted[k]) for k in near):
            continue
        text, end, parts = rows[i], 0, []
        for start, stop, _ in ordered(base_spans(text) + guess_spans(text, cost, 8.0, 6)):
            if start >= end:
                parts += [text[end:start], "[secret]"]
            end = max(end, stop)
        ids = np.array([*library.encode("".join(parts) + text[end:], add_special_tokens=False).ids, 0], "<u4")
        expected += [(i, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    found = corpus_pipeline.run(session, SMALL).toPandas()
    assert sorted(map(tuple, found[["doc_id", "piece", "start", "length", "ids_crc32"]].values.tolist())) == expected
    ends = found.assign(end=found["offset"] + found["length"]).groupby("sequence_id").agg(end=("end", "max"), total=("length", "sum"))
    assert (ends["end"] == ends["total"]).all() and ends["end"].max() <= 2048


def test_stages_keep_columns_and_survive_odd_rows(session, docs):
    odd = docs([(1, None), (2, ""), (3, "a cat sat on the mat " * 3), (4, "a cat sat on the mat " * 3), (5, "five " * 5), (5, "five " * 5), (None, "kept cat"), (None, None)])
    kept = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(session, kept, SMALL)
        assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 5]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(session, docs([]), SMALL).count() == 0
