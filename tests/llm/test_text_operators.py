"""Each text operator against a plain version on small tables with nulls, empty and long texts, copies and odd columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.llm import (
    decontamination,
    fm_index,
    language_id,
    line_dedup,
    order_minhash,
    packing,
    page_diff,
    pii,
    quality_rules,
    queries,
    token_counts,
    toxic_segments,
)
from loadlake.llm.common import ship, split_join
from loadlake.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

WORDS = "time over year people way day man thing woman life child world school state family student group country problem hand".split()
#: Columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, key string, kept string, node long, block long, n_chars long, measured string"


def prose(seed, n, start=0):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(start, start + 40, n), strict=True))


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "k", "x", 1, 2, 3, "m") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


ODD = [None, "", " ", "\n\n", "a", "a", "A b c", prose(1, 30000), "x" * 50000, "é ü 漢字 \x00 \x1c y", prose(2, 60), prose(2, 60)]


# Quality rules ------------------------------------------------------------------------------------------------


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_measures_agree_with_a_plain_count(shipped):
    texts = [*ODD, "a b c d e f a b c d e", "x y\nx y\n\nz\nx y", "a a a a a a a", "# * $x <b>&amp;"]
    found = quality_rules.judged(frame(shipped, texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        n = plain_measures(r.text)
        assert tuple(r.measured)[:5] == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
    assert found[0].lang == "en" and quality_rules.judged(frame(shipped, texts).where("false")).count() == 0


def test_votes_separate_junk_from_prose(shipped):
    good = [prose(i, 150 + i) + ".\nnext line here " + prose(900 + i, 40) + "." for i in range(120)]
    symbols = [" ".join(w + "***" for w in g.split()) for g in good[:20]]
    shouts = [" ".join(w.upper() + "!!" for w in g.split()) for g in good[20:40]]
    told = {r.doc_id: r.kept for r in quality_rules.judged(frame(shipped, good + symbols + shouts)).collect()}
    assert all(told[i] for i in range(120)) and not any(told[i] for i in range(120, 160))


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20000) < 0.7
    accuracy = {"a": 0.95, "b": 0.8, "c": 0.7, "d": 0.9}
    votes = np.stack([np.where(rng.random(20000) < 0.3, 0, np.where((rng.random(20000) < p) == good, 1, -1)) for p in accuracy.values()], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit(patterns, counts.astype(float), list(accuracy), strength=0.001)
    assert abs(model.prior - 0.7) < 0.03
    assert all(abs(model.accuracy(k) - v) < 0.03 for k, v in accuracy.items())
    assert quality_rules.fit(np.zeros((0, 4), int), np.zeros(0), list(accuracy)).prior == 0.8


# Line dedup ---------------------------------------------------------------------------------------------------


def plain_dedup(rows, min_chars=40, min_documents=5):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({i: i + 32 for i in range(65, 91)})

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= min_documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or shared.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("bits", [line_dedup.MAX_BITS, 1 << 17])
def test_shared_lines_leave_all_but_one_document(shipped, bits):
    hot = "This passage stands in very many of these documents, word for word"
    texts = [f"{prose(i, 12)}\n  {hot if i % 2 else hot.upper()}\t\n\n{prose(i % 7, 15)}\nshort" for i in range(60)] + ODD
    texts += [f"{hot}\n{hot}", "ü" * 39, "ü" * 39, "ü" * 39, "ü" * 39, "ü" * 39]
    rows = [*enumerate(texts), (None, hot), (3, texts[3]), (3, f"other\n{hot}")]
    docs = frame(shipped, [t for _, t in rows], [i for i, _ in rows])
    found = [(r.doc_id, *r.deduplicated) for r in line_dedup.deduplicate_lines(docs, max_bits=bits).collect()]
    assert sorted(found, key=repr) == sorted(plain_dedup(rows), key=repr)
    assert line_dedup.deduplicate_lines(docs.where("false")).count() == 0


def test_second_filter_has_every_repeat_of_separate_tasks():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3000)]
    one, two = line_dedup.TwoFilters(1 << 17), line_dedup.TwoFilters(1 << 17)
    for k in keys[:2000]:
        one.add({k})
    for k in keys[1000:]:
        two.add({k})
    merged = one.twice | two.twice | (one.once & two.once)
    assert line_dedup.has(merged, line_dedup.places(keys[1000:2000], 1 << 17)).all()
    assert line_dedup.has(merged, line_dedup.places(keys[:1000], 1 << 17)).mean() < 0.1


# Near duplicates ----------------------------------------------------------------------------------------------


def shingle_set(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def edited(text, seed, n):
    rng = np.random.default_rng(seed)
    words = text.split()
    for i in rng.integers(0, len(words), n):
        words[i] = f"edit{seed}"
    return " ".join(words)


def plain_classes(texts):
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingle_set(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_classes_agree_with_all_pairs(shipped):
    texts = []
    for f in range(12):
        base = prose(100 + f, 250)
        texts += [base] + [edited(base, 10 * f + k, 1 + k) for k in range(6)] + [base]
    texts += [prose(500 + i, 120) for i in range(40)] + [t for t in ODD if t is None or len(t) < 2000]
    passage = prose(77, 60)
    texts += [passage + " " + prose(600 + i, 200) for i in range(30)]
    found = {r.doc_id: r for r in order_minhash.near_duplicates(frame(shipped, texts)).collect()}
    want = plain_classes(texts)
    assert [found[i].class_id for i in range(len(texts))] == want
    assert all(found[i].kept == (want[i] == i) for i in range(len(texts)))
    left = {r.doc_id for r in order_minhash.one_of_each(frame(shipped, texts)).collect()}
    assert left == set(want)


def test_one_large_group(shipped):
    base = prose(9, 120)
    texts = [edited(base, 1, 2)] * 300 + [edited(base, 5 + i, 1) for i in range(300)] + [prose(2000 + i, 100) for i in range(50)]
    found = order_minhash.near_duplicates(frame(shipped, texts))
    sizes = Counter(r.class_id for r in found.collect())
    assert sizes[0] == 600 and len(sizes) == 51


def test_order_and_nulls(shipped):
    words = prose(4, 200).split()
    turned = " ".join(words[100:] + words[:100])
    docs = frame(shipped, [" ".join(words), turned, None, "", "one two", "one two"], [0, 1, 2, 3, 4, 4])
    found = sorted((r.doc_id, r.class_id) for r in order_minhash.near_duplicates(docs).collect())
    assert found == [(0, 0), (1, 1), (2, 2), (3, 2), (4, 4), (4, 4)]  # the halves changed places: no alignment
    nobody = order_minhash.near_duplicates(frame(shipped, ["x y z"], [None])).first()
    assert (nobody.doc_id, nobody.class_id, nobody.kept) == (None, None, True)
    assert order_minhash.near_duplicates(docs.where("false")).count() == 0


def test_alignment_counts_shared_shingles_in_order():
    a = prose(1, 300)
    b = edited(a, 3, 4)
    x, y = (order_minhash.shingles(t.encode()) for t in (a, b))
    sa, sb = shingle_set(a), shingle_set(b)
    assert order_minhash.aligned(x, y) == pytest.approx(len(sa & sb) / len(sa | sb))
    assert order_minhash.aligned(x, x) == 1 and order_minhash.aligned(x, x[::-1].copy()) < 0.5
    values = np.random.default_rng(5).permutation(60)
    best = order_minhash._increasing(values)
    assert (np.diff(values[best]) > 0).all() and (np.diff(best) > 0).all()


def test_repeated_texts_are_near_duplicates_of_the_single_one(shipped):
    texts = []
    for i in range(30):
        base = prose(7000 + i, 150)
        texts += [base, f"{base} {base}", " ".join([base] * 4)]
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(frame(shipped, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == [i - i % 3 for i in range(len(texts))]


def test_similar_pairs_in_a_large_family_of_less_similar_texts(shipped):
    letter, texts = prose(8000, 154), []
    for i in range(1500):  # two letters of a family share 0.7 of their shingles, the two of a pair 0.83
        own = prose(9000 + i, 36).split()
        other = own[:18] + prose(20000 + i, 18).split()
        texts += [f"{letter} {' '.join(own)}", f"{letter} {' '.join(other)}"]
    order = np.random.default_rng(3).permutation(len(texts))
    texts = [texts[i] for i in order]
    sets = [shingle_set(t) for t in texts]
    place = {int(k): i for i, k in enumerate(order)}
    pairs = [sorted((place[2 * i], place[2 * i + 1])) for i in range(1500)]
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in pairs)
    (a, _), (b, _) = pairs[:2]
    assert len(sets[a] & sets[b]) < 0.7 * len(sets[a] | sets[b])
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(frame(shipped, texts)).collect()}
    assert all(found[a] == found[b] == a for a, b in pairs)  # letters of different pairs are not alike


# Decontamination ----------------------------------------------------------------------------------------------


def test_index_agrees_with_a_scan():
    rng = np.random.default_rng(2)
    for n, top in ((1, 1), (40, 2), (500, 3), (3000, 60)):
        text = np.r_[rng.integers(0, top + 1, n), 0]
        index = fm_index.FMIndex(text, top)
        for size in (1, 2, 5):
            patterns = np.array([text[i : i + size] for i in rng.integers(0, max(1, n - size), 30) if (text[i : i + size] > 0).all() and i + size <= n] or [[1] * size])
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high, strict=True):
                want = [i for i in range(len(text) - size + 1) if (text[i : i + size] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def plain_contamination(texts, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if names := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((len(w), hit, found))
    return out


ITEMS = [("1", prose(31, 30)), ("10", prose(32, 12)), ("2", "three little words"), ("3", None), ("4", " .. "), ("5", prose(31, 30)), ("6", "Ünder Der")]


def contaminated_texts():
    return [*ODD, f"before {prose(31, 30).upper()} after", prose(31, 15) + "; " + prose(32, 12).replace(" ", "--"), "Three,little words " * 3,
            "x ünder der", "x Ünder der"] + [f"{prose(40 + i, 30)} {prose(31, 30)}" for i in range(20)]


def test_hits_agree_with_a_scan(shipped, monkeypatch):
    texts = contaminated_texts()
    benchmark = shipped.createDataFrame(ITEMS, "item_id string, text string")
    want = {i: (n, len(hit), sorted(names)) for i, (n, hit, names) in enumerate(plain_contamination(texts, ITEMS))}
    for limit in (decontamination.BLOCK_WORDS, 100):
        monkeypatch.setattr(decontamination.blocks, "__defaults__", (limit,))
        found = decontamination.contamination(frame(shipped, texts), benchmark).collect()
        told = {r.doc_id: (r.n_words, sum(s["end"] - s["first"] for s in r.spans), sorted(r["items"])) for r in found}
        assert told == want
    assert decontamination.contamination(frame(shipped, texts).where("false"), benchmark).count() == 0
    none = decontamination.contamination(frame(shipped, texts), benchmark.where("false")).collect()
    assert len(none) == len(texts) and not any(r.spans or r["items"] for r in none)


@pytest.mark.parametrize("limit", [decontamination.BLOCK_WORDS, 100])
def test_equal_rows_are_results_of_their_own_in_any_number_of_blocks(shipped, monkeypatch, limit):
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (limit,))
    text = f"{ITEMS[0][1]} and {ITEMS[1][1]}"
    docs = frame(shipped, [text] * 4, [7, 7, None, None])
    benchmark = shipped.createDataFrame(ITEMS, "item_id string, text string")
    found = decontamination.contamination(docs, benchmark).collect()
    [(n, hit, names)] = plain_contamination([text], ITEMS)
    assert sorted(r.doc_id or 0 for r in found) == [0, 0, 7, 7]
    assert all((r.n_words, sum(s["end"] - s["first"] for s in r.spans), sorted(r["items"])) == (n, len(hit), sorted(names)) for r in found)


def test_removal_leaves_no_window_and_clean_texts_alone(shipped):
    texts = contaminated_texts()
    w = prose(32, 12).split()
    texts.append(" ".join([*w[:6], *prose(31, 10).split(), *w[6:]]))  # joined again by the first cut
    benchmark = shipped.createDataFrame(ITEMS, "item_id string, text string")
    docs = frame(shipped, texts)
    after = decontamination.decontaminate(docs, benchmark)
    assert after.columns == docs.columns
    kept = {r.doc_id: r.text for r in after.collect()}
    assert not any(hit for _, hit, _ in plain_contamination([kept[i] for i in range(len(texts))], ITEMS))
    for i, (_, hit, _) in enumerate(plain_contamination(texts, ITEMS)):
        if not hit:
            assert kept[i] == texts[i]
    assert kept[len(ODD)] == "before  after"


# Packing and counting -----------------------------------------------------------------------------------------


def test_pieces_hold_the_tokenizers_ids_and_fill_sequences(shipped):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER))
    texts = [*ODD, "don't stop'S we're", "<|endoftext|> x", "Ἀθῆναι ΣΟΦΟΣ İx", "a1b22c ²³ x…y", "a\tb c", *[prose(i, i) for i in range(1, 200)]]
    rows = packing.pack(frame(shipped, texts), tokenizer_path(WORD_TOKENIZER)).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == want, text
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) == -(-sum(r.length for r in rows) // 4096)
    assert packing.pack(frame(shipped, texts).where("false"), tokenizer_path(WORD_TOKENIZER)).count() == 0


def test_any_unicode_gets_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = tokenizer_path(WORD_TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.PieceEncoder(path, lead="")
    rng = np.random.default_rng(31)
    kinds = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x530), (0x1E00, 0x2000), (0x20, 0xD7FF), (0xE000, 0x10FFFF)]
    texts = ["ANKARA ÜNİVERSİTESİ, 1946", "İSTANBUL BELEDİYESİ.", "İ! İİ. ẞ? ΑΣ; ﬁ, Ǆ."]
    for _ in range(20_000):
        parts = ["".join(map(chr, rng.integers(*kinds[rng.integers(len(kinds))], rng.integers(1, 5)))) + "".join(rng.choice(list(".,!?)"), rng.integers(0, 3))) for _ in range(5)]
        texts.append(" ".join(parts))
    for text, ids in zip(texts, packing.token_ids(texts, encoder), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_plan_is_best_fit_over_counts():
    rng = np.random.default_rng(8)
    histogram = {int(n): int(c) for n, c in zip(rng.integers(1, 101, 60), rng.integers(1, 500, 60), strict=True)}
    slots = defaultdict(list)
    for length, first, count, sequence, per, offset in packing.plan(histogram, 100):
        for j in range(count):
            slots[sequence + j // per].append((offset + j % per * length, length, first + j))
    placed = Counter(length for s in slots.values() for _, length, _ in s)
    assert placed == Counter(histogram)
    room: list[int] = []  # best fit, one piece at a time
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min((r for r in set(room) if r >= length), default=None)
            if best is None:
                room.append(100 - length)
            else:
                room[room.index(best)] -= length
    assert len(slots) <= len(room) + 1
    for s in slots.values():
        assert sorted(s)[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(sorted(s), sorted(s)[1:], strict=False))
    assert packing.plan({}, 100) == []


def test_counts_before_and_after_edits_are_the_tokenizers(shipped):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_TOKENIZER))
    tokenizer.encode_special_tokens = True

    def count(text):
        return len(tokenizer.encode(text, add_special_tokens=False).ids)

    texts = [*ODD, "same line\nsame line\nother\nsame line", "call 123456 or 99999", "<|endoftext|> a", "a \n b\t\tc  　 d", "it's  we'll", "x\x1cy !\x1c?"]
    for r in token_counts.counted(frame(shipped, texts), tokenizer_path(BYTE_TOKENIZER)).collect():
        text = r.text or ""
        after = text
        for a, b, new in reversed(token_counts.cleaning_edits(text)):
            after = after[:a] + new + after[b:]
        assert (r.tokens.n_tokens, r.tokens.n_tokens_edited) == (count(text), count(after)), text[:80]


def test_any_edits_keep_the_tree_right():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_TOKENIZER))
    counter = token_counts.Counter(tokenizer_path(BYTE_TOKENIZER))
    rng = np.random.default_rng(4)
    text = prose(5, 2000).replace("time", "time\n\n").replace("day", " day ")
    tree = token_counts.TokenTree(text, counter)
    for _ in range(120):
        a = int(rng.integers(0, len(text) + 1))
        b = min(len(text), a + int(rng.choice([0, 1, 3, 900])))
        new = str(rng.choice(["", " ", "\n", "x", " word", "12 34", "a b c d " * 30]))
        tree.replace(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.total() == len(tokenizer.encode(text, add_special_tokens=False).ids)
    one = token_counts.TokenTree(prose(5, 20000), counter)
    one.replace(1000, 1004, "zz")
    assert one.encoded < 2000


# Labels -------------------------------------------------------------------------------------------------------


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(1)
    for _ in range(200):
        scores = rng.normal(-0.2, 1, rng.integers(1, 30))

        def plain(lo, hi, scores=scores):
            best = max(((scores[a:b].sum(), -b, a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            a, b = best[2], -best[1]
            return [*plain(lo, a), (a, b), *plain(b, hi)]

        assert [(a, b) for a, b, _ in toxic_segments.maximal_segments(scores)] == plain(0, len(scores))


def test_toxic_passages_are_found(shipped):
    bad = ["scum", "idiot", "moron", "trash"]
    texts, toxic = [], []
    for i in range(300):
        words = prose(i, 120).split()
        if i % 5 == 0:
            for k in range(40, 64, 3):
                words[k] = bad[(i + k) % 4]
        texts.append(" ".join(words))
        toxic.append(int(i % 5 == 0))
    texts += ODD
    docs = frame(shipped, texts)
    labels = shipped.createDataFrame([*enumerate(toxic), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxic_segments.fit(docs, labels)
    told = {r.doc_id: r.toxicity for r in toxic_segments.scored(docs, model).collect()}
    assert all((told[i].score >= 0.5) == bool(t) for i, t in enumerate(toxic))
    spans = told[10].passages
    assert len(spans) == 1 and spans[0]["first"] == 40 and 61 <= spans[0]["end"] <= 64
    assert all(0 <= told[i].score < 0.5 for i in range(300, len(texts)))
    nothing = toxic_segments.fit(docs, labels.where("false"))
    assert toxic_segments.scored(docs, nothing).select("toxicity.score").distinct().count() == 1


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    net = language_id.Network(3, hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, labels, weights = rng.integers(97, 103, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 0, 1]), np.array([1.0, 2, 1, 1, 3])
    _, gradient = net.gradient(data, labels, weights)
    for name, value in net.p.items():
        for at in zip(*(rng.integers(0, n, 4) for n in value.shape), strict=True):
            at = (int(rng.integers(97, 103)), *at[1:]) if name[0] == "x" else at
            old, step = value[at], 1e-4
            value[at] = old + step
            up, _ = net.gradient(data, labels, weights)
            value[at] = old - step
            down, _ = net.gradient(data, labels, weights)
            value[at] = old
            assert (up - down) / (2 * step) == pytest.approx(gradient[name][at], abs=2e-4)


def test_languages_on_held_out_documents(shipped):
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["ção", "lh", "ão"]}
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        lang = list(sounds)[i % 3]
        text = " ".join("".join(rng.choice(sounds[lang], rng.integers(1, 4))) for _ in range(40))
        rows.append((i, text, lang))
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(2000, "123 !?", "aa"), (2001, "漢字", None)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, net = language_id.fit(docs)
    assert langs == ["aa", "bb", "cc"]
    told = {r.doc_id: r.language for r in language_id.predicted(docs, langs, net).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([told[i].lang == rows[i][2] for i in held]) > 0.98
    assert {told[i].lang for i in (1000, 1001, 1002, 1003, 2000)} == {"und"} and told[2001].lang != "und"
    assert all(0 <= x.score <= 1 for x in told.values())
    none = language_id.fit(docs.where("false"))
    assert none == ([], None) and {r.language.lang for r in language_id.predicted(docs, *none).collect()} == {"und"}


# Pages --------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x="</p>";</script><style>p{}</style></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<aside class="sidebar"><p>Other</p></aside><!-- <p>hidden</p> --><div class="ad">Buy</div>%s
<form><p>Mail <input name=a></p></form><div id="comments"><article class="comment"><p>First!</p></article></div>
<footer>&copy; 2026</footer></body></html>"""


def test_article_without_its_surroundings(shipped):
    inside = "<article><h1>A &amp;amp; B</h1><p><b>one\n  two<br>three<p>x &lt;y&gt; caf&eacute;&nbsp;z</p><ul><li>i<li>ii</ul><p></p></article>"
    pages = shipped.createDataFrame(
        [(1, "http://a.example/x", PAGE % inside), (2, None, None), (3, "::", ""), (1, "http://a.example/x", PAGE % inside),
         (4, "http://a.example/y", "<p>unclosed <a href='>' x=\"" + "y" * 100000)],
        "page_id long, url string, html string",
    )
    found = sorted((r.page_id, r.url or "", r.text) for r in page_diff.extract(pages).collect())
    want = "A &amp; B\none two three\nx <y> café z\ni\nii"
    assert found[:2] == [(1, "http://a.example/x", want)] * 2 and found[2:4] == [(2, "", ""), (3, "::", "")]
    assert found[4][2].startswith("unclosed")
    assert page_diff.extract(pages.where("false")).count() == 0


def test_parts_of_pages_end_with_their_parents_and_loose_words_are_weak():
    def kept(page):
        return [line for line, mark in page_diff.blocks(page) if mark != page_diff.OUT]

    assert kept("<html><head><title>T</title><meta charset=x><body><p>Text</p>") == ["Text"]
    assert kept("<head><noscript><p>no</p></noscript><link><p>Text</p>") == ["Text"]
    for tag in ("button", "select", "object", "noscript", "svg", "template"):
        assert kept(f"<div>a <{tag}>gone</div><p>b</p>") == ["a", "b"]
        assert kept(f"<p>a <{tag}>gone</{tag}> b</p>") == ["a b"]
    assert kept("<p>a<noscript><p>no</p></noscript> b</p>") == ["a b"]
    assert kept("<head><noscript><body><p>Text</p>") == ["Text"]
    article = "<article><h2 id='related-work'>R</h2><p id='side-effects'>S</p><section id='discussion'>D</section>%s</article>"
    assert kept(article % "<div class='share'>x</div><div class='comments'>y</div>") == ["R", "S", "D"]
    assert kept("<div class='post-header'>H</div><p id='legal'>L</p><div class='sidebar'>x</div>") == ["H", "L"]


def test_open_lines_beside_an_article_are_compared_too():
    page = "<body><div>Menu of all</div><div class='post-title'>Heading</div><p>First part</p><p>Second part</p></body>"
    lines, marks = zip(*page_diff.blocks(page), strict=True)
    assert page_diff.settled(list(marks), [True, False, False, False], list(lines)) == "Heading\nFirst part\nSecond part"


def test_template_lines_are_those_of_the_nearest_page(shipped):
    rows = []
    for i in range(40):
        body = f"<div>Welcome to {'one' if i % 2 else 'two'}</div><p>Story {i} {prose(i, 20)}</p><p>Part {i}</p><div>Write to us</div>"
        rows.append((i, f"https://{'one' if i % 2 else 'two'}.example/s/{i // 2:03d}", f"<html><body>{body}</body></html>"))
    copy = "<html><body><p>Same</p><p>Copy</p></body></html>"
    rows += [(100, "http://c.example/1", copy), (101, "http://c.example/2", copy)]
    pages = shipped.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = {r.page_id: r.text for r in page_diff.extract(pages).collect()}
    assert sum(found[i] == f"Story {i} {prose(i, 20)}\nPart {i}" for i in range(40)) >= 38  # ends of a task's range may lack a neighbour
    assert found[100] == found[101] == "Same\nCopy"
    a, b = [1, 2, 3, 4, 2, 5], [2, 9, 3, 2, 5, 1]
    shared = page_diff.common_lines(a, b)
    assert [x for x, s in zip(a, shared, strict=True) if s] == [2, 3, 2, 5]


# Personal data ------------------------------------------------------------------------------------------------


def luhn(d):
    return sum((v := int(c) * (1 + i % 2)) - 9 * (v > 9) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in patterns.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def pii_texts():
    rng = np.random.default_rng(12)

    def card():
        d = "".join(map(str, rng.integers(0, 10, 15)))
        return next(d + str(c) for c in range(10) if luhn(d + str(c)))

    texts = []
    for i in range(60):
        phone = f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
        texts.append(f"{prose(i, 5)} mail a{i}.b@mail{i}.example.com, ip 10.{i}.7.{i} and {card()} or {phone} x {rng.integers(10**12, 10**13)}")
    lost = [f"é漢 both {'+1 (269) 555-3296'} {card()} end", f"twice {card()} {card()}"]
    odd = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4", "+1 2 +12345678 +123456789 +1(2)3.4-5 6789", "@" * 50 + ".a@b", "a@b" + ".c" * 20000,
           "1 " * 30000, "4111 1111-1111 1111", "1" * 40000, "+1" * 500, "😀 4111111111111111 +49 30 1234567"]
    return texts + lost + odd + ODD


def test_base_spans_and_added_ones(shipped):
    texts = pii_texts()
    docs = frame(shipped, texts)
    model = pii.fit(docs)
    found = {r.doc_id: r for r in pii.private_spans(docs, model).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].b == plain_spans(text), text[:60]
        assert set(filter(None, found[i].b.split(","))) <= set(found[i].s.split(","))
    assert found[60].s == "card:26:42,phone:8:25" and len(found[61].s.split(",")) == 2
    python = [x for x in ("Python", "Pandas", "Arrow", "MapIn") if x in pii.private_spans(docs, model)._jdf.queryExecution().toString()]
    assert not python
    empty = docs.where("false")
    assert pii.private_spans(empty, pii.fit(empty)).count() == 0


def test_counts_of_each_kind_follow_the_spans(shipped, tmp_path):
    mail, ip, card, phone = "a@b.co", "10.0.0.1", "4111111111111111", "+49 30 1234567"
    texts = [f"{mail}, {mail}, {mail}", f"{ip}, {phone}, {ip}", f"{card}; {card}", f"{phone}, {phone}, {mail}, {phone}", "plain", "", None]
    folder = str(tmp_path / "t")
    frame(shipped, [*texts, texts[0]], [*range(6), None, 0]).write.parquet(f"{folder}/documents.parquet")
    found = queries.QUERIES["op9_pii"](shipped, folder).collect()
    counts = {0: (3, 0, 0, 0), 1: (0, 2, 0, 1), 2: (0, 0, 2, 0), 3: (1, 0, 0, 3)}
    assert sorted(str(r.doc_id) for r in found) == ["0", "0", "1", "2", "3", "4", "5", "None"]
    for r in found:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts.get(r.doc_id, (0, 0, 0, 0)), r.doc_id
        plain = plain_spans((texts[r.doc_id] if r.doc_id is not None else None) or "")
        assert r.base_sha256 == hashlib.sha256(plain.encode()).hexdigest()


def test_trees_fit_and_calibrate():
    codes = np.arange(1 << 6)
    good = ((codes & 8) > 0) & ((codes & 32) == 0)
    pos, neg = np.where(good, 50.0, 1.0), np.where(good, 1.0, 50.0)
    model = pii.calibrated(pii.boost(codes, pos, neg), codes, pos, neg)
    margins = model.margins(pii.bits_of(codes))
    assert (margins[good] > 0).all() and (margins[~good] < 0).all()
    assert all(t < margins[good].max() + 1e-6 for t in model.thresholds)
    assert pii.calibrated(model, np.zeros(0, int), np.zeros(0), np.zeros(0)).thresholds == (float("inf"),) * 4


def test_split_join_is_an_inner_join(shipped):
    rows = shipped.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i % 40}", i) for i in range(200)] + [(None, 1)], "key string, v long")
    keyed = rows.where("key IS NOT NULL").groupBy("key").count().withColumnRenamed("count", "n")
    for parts in (1, 3, 1000):
        assert split_join(rows, keyed, "key", "n", parts).count() == 700


def test_time_grows_in_proportion_to_the_matches(shipped):
    import time

    def seconds(n):
        lines = "\n".join(f"10.0.{i % 250}.7 - user{i}@mail.example.com, id {i}" for i in range(n // 2))
        one = " ".join(f"user{i}@mail{i}.example.com" for i in range(n // 2))
        docs = frame(shipped, [lines + "\n" + one])
        started = time.time()
        model = pii.Boosted([], 0.0, (0.0,) * 4)
        row = pii.private_spans(docs, model).select(F.size("base").alias("n"), pii.listed("base").alias("b")).first()
        assert row.n == n // 2 * 3 and row.b == plain_spans(lines + "\n" + one)
        return time.time() - started

    seconds(100)
    assert seconds(50_000) < 60


def test_log_odds_of_odd_words_are_finite(shipped):
    """A word in every document, one in toxic texts only, one class only, repeated rows, columns of other names."""
    texts = [f"the {'vile ' if i % 3 == 0 else ''}{prose(i, 30)}" for i in range(60)]
    docs = frame(shipped, texts + texts[:5] + [None], [*range(60), *range(5), None])
    labels = shipped.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(60)], "doc_id long, toxic int, text string")
    model = toxic_segments.fit(docs, labels)
    told = toxic_segments.scored(docs, model).select("doc_id", "toxicity.score", "key").collect()
    assert len(told) == 66 and all(0 <= r.score <= 1 for r in told)
    found = {r.doc_id: r.score for r in told if r.doc_id is not None}
    assert all((found[i] >= 0.5) == (i % 3 == 0) for i in range(60))
    rows = shipped.createDataFrame([("every", 20.0, 40.0), ("toxic", 20.0, 0.0), ("none", 0.0, 0.0)], "w string, y1 double, y0 double")
    odds, error = toxic_segments.log_odds(F.col("y1"), F.col("y0"), 20.0, 40.0)
    for r in rows.select("w", "y1", "y0", odds.alias("o"), error.alias("e")).collect():
        prior = max(0.5, 50 * (r.y1 + r.y0) / 60)
        rest = max(0.5, 50 - prior)
        a, b = r.y1 + prior, r.y0 + prior
        assert r.o == pytest.approx(np.log(a / (20 - r.y1 + rest)) - np.log(b / (40 - r.y0 + rest))) and r.e == pytest.approx((1 / a + 1 / b) ** 0.5)
    only = toxic_segments.fit(docs, labels.where("toxic = 1"))
    assert toxic_segments.scored(docs, only).select("toxicity.score").distinct().count() == 1
