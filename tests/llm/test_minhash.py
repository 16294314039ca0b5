import random

from lakemart.llm import minhash as M
from tests.llm.corpus import empty_documents, odd_documents, words

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_set(text, size=4):
    w = [x for x in (text or "").translate(LOW).replace("\x0b", " ").split() if x] if text else []
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def plain_components(rows, size=4, least=80):
    sets = [plain_set(t, size) for _, t in rows]
    label = {i: i for i, _ in rows}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = sorted((top(rows[a][0]), top(rows[b][0])))
                label[y] = x
    return {i: (len(s), top(i)) for (i, _), s in zip(rows, sets)}


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_stars_chains_and_copies(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(12):  # a centre and copies that are nearer to it than to each other
        base = words(rng, 150, 5000)
        rows += [base, base.upper(), *(changed(rng, base, 4) for _ in range(rng.randrange(1, 40)))]
        link = base
        for _ in range(4):
            link = changed(rng, link, 3)
            rows.append(link)
    rows += [words(rng, rng.randrange(0, 200), 5000) for _ in range(100)] + ["a b c", "A b  c", "a b", "", "  "]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_crowded_regions(spark):
    rng = random.Random(4)
    base = words(rng, 120, 5000)
    rows = list(enumerate([base, *(changed(rng, base, rng.randrange(1, 5)) for _ in range(300))]))
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows)
    wrong = [r.doc_id for r in found if r.component_id != want[r.doc_id][1]]
    assert not wrong


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = M.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[9].component_id == 1 and not by_id[9].kept and by_id[1].kept
    assert by_id[2].n_shingles == 0 and by_id[2].component_id == 2 and by_id[2].kept
    assert by_id[11].component_id == 10 and by_id[8].n_shingles == 1
    assert not any(r.kept for r in found if r.doc_id is None)
    assert M.near_duplicates(empty_documents(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    labels = {r.node: r.label for r in M.components(links).collect()}
    assert {labels[i] for i in range(41)} == {0} and labels[101] == 100


def test_every_link_inside_a_crowded_region_is_found(spark):
    """Loose copies of one text crowd the regions of few short trees, so that most
    of the close pairs among them are neither neighbours nor with a hub or leader."""
    rng = random.Random(11)
    base = words(rng, 120, 5000)
    loose = [changed(rng, base, 3) for _ in range(400)]
    rows = list(enumerate(loose + [changed(rng, loose[i], 2) for i in range(0, 400, 4)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    regions = {r.doc_id: set(r.regions) for r in M.sign(docs, 4, 3, 2).collect()}
    sets = {i: plain_set(t) for i, t in rows}
    links = [
        (a, b) for a in regions for b in regions
        if a < b and regions[a] & regions[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    assert len(links) > 50
    want = {r.node: r.label for r in M.components(spark.createDataFrame(links, "a long, b long")).collect()}
    found = {r.doc_id: r.component_id for r in M.near_duplicates(docs, trees=3, depth=2).collect()}
    assert found == {i: want.get(i, i) for i, _ in rows}


def test_parity_bits_never_exceed_the_difference():
    rng = random.Random(9)
    for _ in range(200):
        a = M.shingles(words(rng, rng.randrange(1, 300), 50))
        b = M.shingles(words(rng, rng.randrange(1, 300), 50)) if rng.random() < 0.5 else a[rng.randrange(max(1, len(a) // 4)) :]
        apart = sum(int(x).bit_count() for x in (M.parity(a) ^ M.parity(b)).view("uint64"))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist())) and (apart - len(a) - len(b)) % 2 == 0
