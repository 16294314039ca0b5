import itertools
import random
import re
import time
from collections import Counter, defaultdict

from lakemart.llm import lines as L
from tests.llm.corpus import empty_documents, odd_documents


def test_patience_is_a_longest_rising_run():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(0, 8)
        pairs = list(zip(range(n), rng.sample(range(20), n)))
        rng.shuffle(pairs)
        found = L.patience(pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(found, found[1:])) and set(found) <= set(pairs)
        ordered = sorted(pairs)
        best = max(
            (len(c) for k in range(n + 1) for c in itertools.combinations(ordered, k) if all(a[1] < b[1] for a, b in zip(c, c[1:]))), default=0
        )
        assert len(found) == best


def test_blocks_need_words():
    aligned = [(0, 5), (1, 6), (2, 9), (5, 10), (6, 11)]
    assert L.blocks(aligned, {0: 3, 1: 3, 2: 5, 5: 1, 6: 6}, 6) == [0, 1, 5, 6]


def plain_blocks(pairs, words, least=8):
    """Blocks of a pair and those that moved, with stretches as diagonals of a table."""

    def long(left):
        out = set()
        for shift in {a - b for a, b in left}:
            ends = sorted(a for a, b in left if a - b == shift)
            for _, run in itertools.groupby(enumerate(ends), lambda x: x[1] - x[0]):
                run = [a for _, a in run]
                if sum(words[a] for a in run) >= least:
                    out.update((a, a - shift) for a in run)
        return out

    gone = set(L.blocks(L.patience(list(long(set(pairs)))), words, least))
    return gone | {a for a, _ in long({p for p in pairs if p[0] not in gone})}


def plain_cut(rows):
    """The texts left, with each line matched to its first holder in plain Python."""
    first, tokens = {}, {}
    for i, text in sorted(rows):
        seen = Counter()
        tokens[i] = []
        for k, line in enumerate((text or "").split("\n")):
            line = " ".join(line.replace("\t", " ").replace("\r", " ").split(" ")).strip(" ")
            line = re.sub(" +", " ", line)
            if line:
                seen[line] += 1
                key = (line, seen[line])
                tokens[i].append((k, key))
                first.setdefault(key, (i, k))
    out = {}
    for i, text in rows:
        pairs = defaultdict(list)
        for k, key in tokens[i]:
            owner, at = first[key]
            if owner != i:
                pairs[owner].append((k, at, len(key[0].split(" "))))
        gone = set()
        for found in pairs.values():
            gone.update(plain_blocks([m[:2] for m in found], {m[0]: m[2] for m in found}))
        out[i] = "\n".join(line for k, line in enumerate((text or "").split("\n")) if k not in gone)
    return out


def sentence(rng, n=12):
    return " ".join(f"w{rng.randrange(900)}" for _ in range(n))


def test_common_blocks_go_from_the_later_document(spark):
    rng = random.Random(6)
    common = [sentence(rng) for _ in range(4)]
    own = [[sentence(rng) for _ in range(3)] for _ in range(4)]
    rows = [
        (1, "\n".join([own[0][0], *common, own[0][1]])),
        (2, "\n".join([own[1][0], common[0], common[1] + "  ", "", own[1][1], common[2]])),
        (3, "\n".join([common[3], own[2][0], common[0]])),  # against the order: one is aligned, the other moved
        (4, "\n".join(own[3])),
        (5, "\n".join([common[0], common[0], own[3][0] + " tail"])),
        (6, "yes\nno\nyes"), (7, "yes\nno\nyes"), (8, "yes"),
    ]
    found = {r.doc_id: r for r in L.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert found[1].text == texts[1] and found[4].text == texts[4]
    assert found[2].text.split("\n") == [own[1][0], "", own[1][1]]
    assert found[3].text == own[2][0]
    assert found[5].text.split("\n") == [common[0], own[3][0] + " tail"]
    assert found[7].text == texts[7] and found[8].text == "yes"  # too few words


def test_frequent_long_line_goes_everywhere_but_first(spark):
    rng = random.Random(7)
    line = sentence(rng, 60)
    rows = [(i, "\n".join([sentence(rng), line, sentence(rng)])) for i in range(60)]
    found = {r.doc_id: r.n_removed for r in L.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0] == 0 and all(found[i] == 1 for i in range(1, 60))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = L.remove_lines(docs)
    assert sorted(found.columns) == sorted([*docs.columns, "n_lines", "n_removed"])
    rows = found.collect()
    assert len(rows) == docs.count()
    fives = sorted(r.text for r in rows if r.doc_id == 5)
    assert fives == ["", "", "another text"]
    assert {r.doc_id for r in rows if r.n_removed} == {5, 12}
    assert [r.text for r in rows if r.doc_id == 2] == [None]
    assert L.remove_lines(empty_documents(spark)).count() == 0


def all_pairs_cut(rows):
    """The texts left where each document is aligned with every earlier one."""
    keyed = []
    for i, text in sorted(rows):
        seen, found = Counter(), {}
        for k, line in enumerate(text.split("\n")):
            seen[line] += 1
            if line:
                found[line, seen[line]] = k
        keyed.append((i, found))
    gone = defaultdict(set)
    for n, (i, later) in enumerate(keyed):
        for _, earlier in keyed[:n]:
            pairs = [(k, earlier[key]) for key, k in later.items() if key in earlier]
            gone[i].update(plain_blocks(pairs, {k: len(key[0].split(" ")) for key, k in later.items()}))
    return {i: "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


def test_passages_of_short_lines_against_all_pairs(spark):
    rng = random.Random(8)
    verse = [sentence(rng, 6) for _ in range(12)]
    song = [sentence(rng, 3) for _ in range(9)]
    listed = [sentence(rng, rng.randrange(1, 7)) for _ in range(10)]
    rows = [(i, "\n".join([sentence(rng, 5), line, sentence(rng, 5)])) for i, line in enumerate([*song, *verse[::2]])]
    for i in range(100, 160):  # more documents than a rare line has
        cut, end = sorted(rng.sample(range(11), 2))
        parts = [[sentence(rng, 9)], verse if i % 2 else verse[cut : end + 1], [sentence(rng, 4), ""], song, listed[cut:] if i % 3 else [], [sentence(rng, 2)]]
        rows.append((i, "\n".join(itertools.chain(*parts))))
    found = {r.doc_id: r.text for r in L.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == all_pairs_cut(rows)
    assert not any(set(song) & set(found[i].split("\n")) for i in range(101, 160))


def test_passages_in_changed_order_against_all_pairs(spark):
    rng = random.Random(9)
    one, two = ([sentence(rng, 10) for _ in range(3)] for _ in range(2))
    rows = [(1, "\n".join(two + one)), (2, "\n".join(one + two)), (3, "\n".join(one + two))]
    passages = [[sentence(rng, rng.choice([2, 3, 5, 12])) for _ in range(rng.randrange(5, 12))] for _ in range(9)]
    rows.append((10, "\n".join(itertools.chain(*passages))))
    for i in range(11, 60):
        held = rng.sample(passages, rng.randrange(1, 9))
        rows.append((i, "\n".join(itertools.chain(*([*p, sentence(rng, 4)] if rng.random() < 0.5 else p for p in held)))))
    found = {r.doc_id: r for r in L.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[3].text == "" and found[3].n_removed == 6
    assert {i: r.text for i, r in found.items()} == all_pairs_cut(rows)
    assert not any(line in found[i].text.split("\n") for i in range(11, 60) for p in passages for line in p)


def test_stretch_beside_a_longer_alignment_of_scattered_lines():
    # three scattered lines outnumber the block, but make none themselves
    pairs = {(0, 10), (1, 11), (2, 0), (3, 2), (4, 4)}
    assert L.common_blocks(pairs, {0: 6, 1: 6, 2: 3, 3: 3, 4: 3}) == {0, 1}
    assert L.common_blocks(set(), {}) == set()


def test_time_of_lines_in_any_order():
    rng = random.Random(10)
    n = 200_000
    start = time.monotonic()
    for order in (rng.sample(range(n), n), range(n)[::-1], range(n)):
        assert len(L.common_blocks(set(zip(range(n), order)), dict.fromkeys(range(n), 9))) == n
    assert time.monotonic() - start < 60
