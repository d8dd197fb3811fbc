import re
from collections import Counter

import numpy as np
import pytest

from meterline.llm import double_array, phrases

DOCS = "text string, lang string, word string, key string, k1 string, n string"


def plain(rows, least, part_percent=50, most=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    result = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        kept = []
        for phrase, a in frequent.items():
            inside = [b for p, b in frequent.items() if len(p) > len(phrase) and phrase in (p[:2], p[1:])]
            if any(100 * b >= part_percent * a for b in inside):
                continue
            cuts = [(1_000_000 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def check(spark, rows, least, most=2000):
    docs = spark.createDataFrame([(*row, "clash", "clash", "clash", "clash") for row in rows], DOCS).repartition(3)
    got = phrases.collocations(docs, least, most=most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least, most=most)


def drawn(size, words, seed):
    draw = np.random.default_rng(seed)
    names = np.array([f"w{i}" for i in range(words)] + ["É", "ñ", "New", "YORK", "a-b"])
    marks = [" ", " ", " ", "\t", "  ", ". ", "\n", ", ", "!"]
    rows = []
    for i in range(size):
        picks = names[draw.zipf(1.4, int(draw.integers(0, 60))) % len(names)]
        text = "".join(word + marks[draw.integers(len(marks))] for word in picks)
        rows.append((text, [None, "und", "en", "fr"][i % 4]))
    return rows


@pytest.mark.parametrize("trie", [1 << 20, 7])
def test_equals_counting_all_phrases(spark, monkeypatch, trie):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", trie)  # 7: many tries, several passes
    monkeypatch.setattr(phrases, "TRIES_A_PASS", 8)
    check(spark, drawn(120, 12, trie) + [("New York City. " * 30, "en"), ("x " * 40, "fr")], least=10)


def test_one_broadcast_lives_at_a_time(spark, monkeypatch):
    """What the driver has sent for one pass is given up before the next."""
    alive, send = [0], phrases.broadcast

    def sent(session, value):
        found = send(session, value)
        alive[0] += 1
        assert alive[0] == 1
        monkeypatch.setattr(found, "destroy", lambda: alive.__setitem__(0, alive[0] - 1), raising=False)
        return found

    monkeypatch.setattr(phrases, "broadcast", sent)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 3)
    check(spark, drawn(40, 6, 5), 2)
    assert alive == [0]


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", 50)
    rows = [("one two three, four one two. " * 20, "en"), ("no break at all " * 20, "en"), ("a b\n" * 15 + "é" * 80, "en")]
    check(spark, rows, least=5)


def test_few_rows_are_kept_in_order(spark):
    check(spark, drawn(150, 30, 5), least=3, most=5)


def test_ranks_are_cut_before_a_language_comes_together(spark):
    """Spelled and ranked by language are the first ones and their ties alone, in one task each."""
    draw = np.random.default_rng(1)
    rows = [(i, int(draw.integers(1, 10)), int(draw.integers(0, 50))) for i in range(1, 40_001)]
    scored = spark.createDataFrame(rows, "k1 long, a long, score long").selectExpr(
        "'en' AS lang", "k1", "k1 AS k2", "0L AS k3", "a", "1L AS l", "1L AS r", "CAST(score AS DECIMAL(38, 0)) AS score"
    )
    words = spark.createDataFrame([("en", f"w{i}", i, 1) for i, _, _ in rows], "lang string, word string, key long, n long")
    seen, usual = spark.sparkContext.accumulator(0), phrases.F.concat_ws

    @phrases.F.udf("string")
    def counted(phrase):
        seen.add(1)
        return phrase

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases.F, "concat_ws", lambda *columns: counted(usual(*columns)))
        got = phrases._ranked(scored, words, 50).collect()
    first = sorted(rows, key=lambda row: (-row[2], -row[1], f"w{row[0]} w{row[0]}"))
    assert [(row["phrase"], row["a"], row["score"]) for row in sorted(got, key=lambda row: row["rank"])] == [
        (f"w{i} w{i}", a, score) for i, a, score in first[:50]
    ]
    assert seen.value < 1_000


def test_nulls_repeated_rows_and_nothing(spark):
    check(spark, [(None, None), ("", "en"), (" .\n", None)], least=1)
    check(spark, [("a b c", "en")] * 12 + [("A B", None)] * 11 + [(None, "en")], least=10)
    check(spark, [], least=10)


@pytest.mark.parametrize("shared", [3, 0])
def test_words_that_share_a_key_get_other_keys(spark, monkeypatch, shared):
    usual = phrases.keyed_words

    def colliding(langs, texts, seed):
        words, keys, following = usual(langs, texts, seed)
        return words, (keys & np.uint64(shared)) + np.uint64(1) if seed == 0 else keys, following

    monkeypatch.setattr(phrases, "keyed_words", colliding)
    check(spark, drawn(60, 5, 3), least=10)


@pytest.mark.parametrize("size, symbols", [(1, 1), (9, 2), (800, 10), (3_000, 150)])
def test_double_array_counts_what_occurs(size, symbols):
    draw = np.random.default_rng(size)

    def keys(n):
        return (draw.zipf(1.3, n) % symbols).astype(np.uint64) * np.uint64(7919) + np.uint64(1)

    wanted = np.stack([keys(size), keys(size), keys(size)], axis=1)
    lengths = draw.integers(1, 4, size)
    wanted[lengths == 1, 1] = 0
    wanted[lengths <= 2, 2] = 0
    wanted = np.unique(wanted, axis=0)
    trie = double_array.build(wanted)
    states = trie.states_of(wanted)
    assert (states >= 0).all() and len(set(states.tolist())) == len(wanted)
    text = np.concatenate([keys(4_000), np.arange(2, 7, dtype=np.uint64)])
    following = draw.random(len(text)) < 0.9
    following[-1] = False
    totals = sum(np.bincount(s, minlength=len(trie.check)) for s in trie.walk(trie.symbols(text), following, 3))
    seen, words = Counter(), text.tolist()
    for i in range(len(words)):
        seen[(words[i], 0, 0)] += 1
        if following[i]:
            seen[(words[i], words[i + 1], 0)] += 1
            if following[i + 1]:
                seen[(*words[i : i + 3],)] += 1
    assert [totals[s] for s in states] == [seen[tuple(p)] for p in wanted.tolist()]


def test_more_tries_take_no_more_passes_over_the_texts(spark, monkeypatch):
    rows, read = drawn(40, 6, 5), []
    for size in (1 << 20, 40):
        monkeypatch.setattr(phrases, "TRIE_PHRASES", size)
        seen = spark.sparkContext.accumulator(0)

        def passed(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        docs = spark.createDataFrame(rows, "text string, lang string").mapInArrow(passed, "text string, lang string")
        assert sorted(map(tuple, phrases.collocations(docs, 2).collect())) == plain(rows, 2)
        read.append(seen.value)
    assert read[0] == read[1] > 0


def test_places_that_the_table_lets_through_are_not_counted(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 7)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 7)
    monkeypatch.setattr(phrases, "TRIE_WORDS", 50)  # some tries have places but no phrases
    monkeypatch.setattr(phrases, "DEALT_PLACES", 100)
    monkeypatch.setattr(phrases, "_PLACES_A_ROW", 3)
    check(spark, drawn(100, 12, 8), least=10)


def test_tries_are_built_dense_and_walked_by_rows():
    draw = np.random.default_rng(3)
    names = draw.integers(1, 1 << 64, 3_000, np.uint64)
    wanted = np.unique(names[draw.zipf(1.2, (60_000, 3)) % 3_000], axis=0)
    wanted[::2, 2] = 0
    wanted = np.unique(wanted, axis=0)
    trie = double_array.build(wanted)
    assert len(trie.check) < 40 * len(wanted)
    known = dict(zip(map(tuple, wanted.tolist()), trie.states_of(wanted).tolist()))
    begins = {key[:2] + (0,) for key in known}
    others = names[draw.integers(0, 3_000, (20_000, 3))]
    others[::3, 1:] = 0
    rows = np.concatenate([wanted, others, others + np.uint64(1)])
    found = list(trie.walk_rows(rows))
    for level in (1, 2):
        reached = {tuple(row[: level + 1]) for row in rows[found[level][0]].tolist()}
        want = [row for row in rows.tolist() if row[level] and ((*row[: level + 1], 0)[:3] in (begins if level == 1 else known))]
        assert reached == {tuple(row[: level + 1]) for row in want} and len(found[level][0]) == len(want)
    for which, states in found[1:]:
        full = [(known.get(tuple(rows[i].tolist())), s) for i, s in zip(which.tolist(), states.tolist())]
        assert any(a == b for a, b in full)
    exact = {tuple(rows[i].tolist()): s for i, s in zip(found[2][0].tolist(), found[2][1].tolist())}
    assert all(exact[key] == state for key, state in known.items() if key[2])
