"""Spelling variants, id files and hard negatives against plain versions."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.llm import hard_negatives, id_coder, id_files, spelling, token_counts
from loadlake.llm.common import ship
from loadlake.llm.queries import BYTE_TOKENIZER, tokenizer_path

SCHEMA = "doc_id long, text string, word string, n long, near string, root string"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "w", 1, "x", "y") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


# Spelling variants ----------------------------------------------------------------------------------------------


def plain_counts(docs):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_variants(vocabulary):
    near = {w: [v for v in vocabulary if one_apart(w, v)] for w in vocabulary}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best and vocabulary[best] >= 2 * vocabulary[w] else None
    out = set()
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), vocabulary[form[w]] if form[w] else None))
    return out


def letters(rng, n, alphabet="abcdeé"):
    return "".join(rng.choice(list(alphabet), n))


def test_variants_agree_with_all_pairs(shipped):
    rng = np.random.default_rng(3)
    words = [letters(rng, rng.integers(4, 8)) for _ in range(150)] + ["x" * 3000, "x" * 3001, "x" * 2999 + "ÿ", "aaaaa", "aaaaaa", "Éàaaa", "éàaaa"]
    words += [w[:2] + w[3:] for w in words[:60]]
    texts = [" ".join(rng.choice(words, 120)) + f" {i}2world×wide' 漢字school-hous" for i in range(60)]
    texts[7] += " chainone" * 40 + " chainon" * 12 + " chaion" * 4
    texts += [None, "", "  ", "Short", texts[0], texts[0], "AAAAA aaaaa Aaaaa ÉÀAAA " * 400]
    ids = [*range(len(texts) - 4), None, 5, 5, 6]
    found = spelling.variants(spelling.vocabulary(frame(shipped, texts, ids)))
    expected = plain_variants(plain_counts(zip(ids, texts, strict=True)))
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()} == expected
    assert any(f and r != f for _, f, r, *_ in expected)  # some chain has several steps


def test_no_words_at_all(shipped):
    assert spelling.variants(spelling.vocabulary(frame(shipped, [None, "", "12 34"]))).count() == 0
    assert spelling.variants(spelling.vocabulary(frame(shipped, ["a"]).where("false"))).count() == 0


def test_shards_and_rounds_change_nothing(shipped, monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary = {letters(rng, rng.integers(5, 8), "abcd"): int(rng.integers(3, 40)) for _ in range(600)}
    words = shipped.createDataFrame(list(vocabulary.items()), "word string, n long")
    cut = spelling.shards
    monkeypatch.setattr(spelling, "shards", lambda sizes: cut(sizes, 100))
    rounds = spelling.shard_rounds
    monkeypatch.setattr(spelling, "shard_rounds", lambda s: rounds(s, 700))
    assert len(list(rounds(cut({5: 250, 6: 250}, 100), 700))) > 1
    found = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.variants(words).collect()}
    assert found == plain_variants(vocabulary)


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(5)
    inside, outside = rng.integers(0, 1 << 63, (2, 50_000)).astype(np.uint64)
    table = spelling.build(inside, spelling.blocks_for(len(inside)))
    assert spelling.has(table, inside).all() and spelling.has(table, outside).mean() < 0.01


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "_TEXT_AT_ONCE", 7)
    text = "Über die Straße, naïve×façade; 漢字 abcdefghijklmnop’s x" * 5
    whole = re.findall("[a-zÀ-ÿ]+", text.encode().lower().decode())
    assert [r.decode() for some in spelling.runs(text.encode()) for r in some] == whole


# Hard negatives -------------------------------------------------------------------------------------------------


def plain_mined(rows):
    """Rows of (id, label, vector or None)."""
    rows = {(i, (k + 1) % 10 if i % 7 == 0 else k, tuple(int(np.floor(256 * float(x))) for x in v)) for i, k, v in usable_rows(rows)}
    out = set()

    def score(v, w):
        return sum(x * y for x, y in zip(v, w, strict=False))

    for i, label, v in rows:
        if i % 100:
            continue
        met = sorted((-score(v, w), j, k) for j, k, w in rows)
        positives = [(-s, j) for s, j, k in met if k == label and j != i][:5]
        for p, j in positives:
            fit = [(-s, n) for s, n, k in met if k != label and 30 * p <= -100 * s <= 90 * p][:10]
            out |= {(i, j, rank, n, p, s) for rank, (s, n) in enumerate(fit, 1)}
    return out


def usable_rows(rows):
    return [(i, k, v) for i, k, v in rows if i is not None and k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]


def vectors(rng, n, width=6, spread=0.3):
    centres = rng.normal(0, 1, (10, width))
    label = rng.integers(0, 10, n)
    return label, (centres[label] + rng.normal(0, spread, (n, width))).astype(np.float32)


def mined(spark, rows, block=hard_negatives.ANCHOR_BLOCK):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, label int, embedding array<float>, vector string, anchor int, score int").repartition(5)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mined(hard_negatives.usable(frame, moved), F.col("vec_id") % 100 == 0, anchor_block=block)
    rows = [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def odd_vectors(rng):
    label, v = vectors(rng, 3000)
    rows = [(i * 5, int(k), x.tolist()) for i, (k, x) in enumerate(zip(label, v, strict=True))]
    rows += [(9 + 10 * i, 3, rows[40][2]) for i in range(300)]  # ties
    rows += [(100, 4, [0.0] * 6), (20_000, 4, [0.0] * 6), (20_100, 5, []), (20_200, 5, [1.0, 2.0]), (20_300, 5, [float("nan")] * 6)]
    rows += [(20_400, None, [1.0] * 6), (None, 1, [1.0] * 6), (20_500, 1, None), (20_600, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (20_700, 77, [1.0] * 6)]
    rows += [(20_800, 2, [float("inf")] + [0.0] * 5), (-100, 3, rows[7][2])]
    return [r for r in rows if r is not rows[20]] + rows[:20]


def test_negatives_agree_with_all_pairs(shipped):
    rows = odd_vectors(np.random.default_rng(11))
    expected = plain_mined(rows)
    assert len(expected) > 500
    assert mined(shipped, rows) == expected
    assert mined(shipped, rows, block=20) == expected  # several blocks of anchors


def test_large_components_stay_exact(shipped):
    rng = np.random.default_rng(12)
    label, v = vectors(rng, 300, width=3)
    rows = [(i * 10, int(k), [float(np.float32(y * 1e4)) for y in x]) for i, (k, x) in enumerate(zip(label, v, strict=True))]
    assert mined(shipped, rows) == plain_mined(rows)
    wide = [(i, k, [y * 100 for y in x]) for i, k, x in rows]
    assert mined(shipped, wide) == plain_mined([(i, k, [float(np.float32(y)) for y in x]) for i, k, x in wide])


def test_no_anchor_or_no_row(shipped):
    assert mined(shipped, [(1, 1, [1.0])]) == set() and mined(shipped, [(100, 1, [1.0])]) == set()
    frame = shipped.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mined(hard_negatives.usable(frame), F.lit(True)).count() == 0


def test_lists_end_early_where_directions_part():
    rng = np.random.default_rng(13)
    label, v = vectors(rng, 6000, width=24, spread=0.05)
    v = np.floor(v.astype(float) * 256)
    rows = hard_negatives.Rows(np.arange(6000), label, v, np.linalg.norm(v, axis=1))
    anchors = hard_negatives.Rows(*[x[:100] for x in rows])
    clusters = hard_negatives.clustered(anchors)
    assert sorted(np.concatenate(clusters.members)) == list(range(100))
    collect = hard_negatives.Positives(anchors, 5)
    assert hard_negatives.walk(rows, anchors, clusters, collect) < 0.5 * 600_000
    for a in range(100):
        s = v @ v[a]
        s[(label != label[a]) | (np.arange(6000) == a)] = -1e18
        assert collect.lists.ids[a].tolist() == np.lexsort((np.arange(6000), -s))[:5].tolist()


# Id files -------------------------------------------------------------------------------------------------------


def id_rows(rng):
    yield from (np.zeros(0), np.array([0]), np.array([2**32 - 1] * 2000), rng.integers(0, 50257, 3000), rng.integers(0, 2**32, id_coder.BLOCK + 1))
    yield np.tile(rng.integers(0, 300, 400), 10)
    yield rng.zipf(1.3, 8_000) % 50257
    yield np.concatenate([np.arange(id_coder.BLOCK), np.zeros(2500), np.arange(2000)[::-1]])


def test_coded_blocks_decode_to_the_same_ids(monkeypatch):
    rng = np.random.default_rng(21)
    for lanes in (id_coder.LANES, 5):
        monkeypatch.setattr(id_coder, "LANES", lanes)
        for ids in id_rows(rng):
            ids = ids.astype("<u4")
            coded = id_coder.encode(ids)
            assert id_coder.decode(coded).tolist() == ids.tolist()
    repeated = np.tile(rng.integers(0, 50257, 100), 10).astype("<u4")
    assert len(id_coder.encode(repeated)) < 600  # 100 ids at two bytes, the rest predicted


def test_damaged_blocks_are_noticed():
    coded = bytearray(id_coder.encode(np.arange(3000, dtype="<u4") % 700))
    for at in (20, len(coded) // 2, 13):
        broken = bytes(coded[:at] + bytes([coded[at] ^ 1]) + coded[at + 1 :])
        with pytest.raises(ValueError, match="damaged"):
            id_coder.decode(broken)


def test_id_files_hold_the_tokenizers_ids_in_order(shipped, tmp_path):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(22)
    texts = ["Hello world, it's  ok.\n\n\tNaïve 漢字 <|endoftext|> x<|endoftext|>", "", None, "a" * 20_000, " " * 9000, "\n", "word " * 9000]
    texts += [" ".join(letters(rng, rng.integers(1, 9), "aeioustr é\n'.9<|") for _ in range(rng.integers(1, 200))) for _ in range(150)]
    texts += [texts[0], texts[0], texts[8], "null id", "null id", "another null id"]
    ids = [*(int(i) for i in rng.permutation(len(texts) - 6) - 40), 3, 3, 3, None, None, None]
    home = str(tmp_path / "ids")
    id_files.write(frame(shipped, texts, ids), tokenizer_path(BYTE_TOKENIZER), home, page_ids=500)
    rows = sorted(((r.start, r.doc_id, r.ids) for r in id_files.read(shipped, home).collect()), key=lambda r: r[0])
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_TOKENIZER))
    expected = Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in zip(ids, texts, strict=True))
    assert Counter((i, bytes(x)) for _, i, x in rows) == expected
    assert [i for _, i, _ in rows] == [None] * 3 + sorted(i for i in ids if i is not None)
    assert [s for s, *_ in rows] == np.cumsum([0, *(len(x) // 4 for *_, x in rows[:-1])]).tolist()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(id_files, "CHARS_AT_ONCE", 50)
        assert "".join(id_files.parts_of(texts[9], 50)) == texts[9]


def test_no_documents_make_no_ids(shipped, tmp_path):
    home = str(tmp_path / "ids")
    id_files.write(frame(shipped, ["x"]).where("false"), tokenizer_path(BYTE_TOKENIZER), home)
    assert id_files.read(shipped, home).count() == 0


# Token counts of kept trees -------------------------------------------------------------------------------------


def test_stored_leaves_follow_edits(shipped, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_path(BYTE_TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = np.random.default_rng(41)
    texts = [" ".join(letters(rng, rng.integers(1, 9), "aeiou st\n.9") for _ in range(n)) for n in (0, 1, 40, 900, 3000, 500)] + [None, "untouched " * 500]
    docs = frame(shipped, texts)
    token_counts.leaf_table(docs, path).write.parquet(str(tmp_path / "leaves"))
    leaves = shipped.read.parquet(str(tmp_path / "leaves"))
    for _ in range(3):  # edits of what earlier edits left
        rows = []
        for i, text in enumerate(texts[:7]):
            n, at = len(text or ""), 0
            while at <= n and len(rows) < 40 * (i + 1):
                start = at + int(rng.integers(0, 300))
                end = start + int(rng.integers(0, 40))
                rows.append((i, start, end, [None, "", " ", "x", "new words here ", " word " * 200][rng.integers(6)]))
                at = max(end, start) + 1
        rows += [(2, 10**9, 10**9 + 5, "tail"), (99, 0, 1, "nobody"), (None, 0, 1, "x"), (3, 0, 5, "a"), (3, 2, 4, "overlaps")]
        edits = shipped.createDataFrame(rows, "doc_id long, start long, end long, text string")
        for i, text in enumerate(texts):
            text, end, parts = text or "", 0, []
            for _, a, b, new in sorted((r for r in rows if r[0] == i), key=lambda r: (r[1], r[2], r[3] or "")):
                a, b = min(a, len(text)), min(b, len(text))
                if a >= end:
                    parts, end = [*parts, text[end:a], new or ""], b
            texts[i] = "".join([*parts, text[end:]])
        leaves = token_counts.edited(leaves, edits, path).checkpoint()
        told = {r.doc_id: r for r in token_counts.totals(leaves).collect()}
        whole = {i: "".join(r.text for r in sorted(leaves.where(F.col("doc_id") == i).collect(), key=lambda r: r.leaf)) for i in (2, 4, 7)}
        assert all(whole[i] == texts[i] for i in whole)
        for i, text in enumerate(texts):
            assert told[i].n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids) and told[i].n_chars == len(text)
    assert told[7].n_chars_encoded == 0
    one = token_counts.totals(token_counts.edited(leaves, shipped.createDataFrame([(4, 50, 51, "y")], edits.schema), path)).where("doc_id = 4").first()
    assert one.n_chars_encoded < 0.2 * one.n_chars
