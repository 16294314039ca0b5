import random

from lakemart.llm import minhash


def test_members_that_meet_no_other_label_are_left_out(spark):
    rng = random.Random(5)
    rows = [(1, n, 4, n, 1000 - n, 7 if n not in (90, 95) else n) for n in range(100)]  # leaders of one label, two members of others
    rows += [(2, n, 4, n, 1, 8) for n in range(200, 300)]  # one label only
    rows += [(3, n, 4, n, rng.randrange(9), n % 3) for n in range(300, 340)]  # uncrowded: 24 leaders of three labels
    rows += [(4, n, 4, n, 1, 9) for n in (400, 401, 402)] + [(4, 403, 4, 403, 0, 5)]
    rows += [(5, 500, 4, 500, 1, 500)]
    placed = spark.createDataFrame(rows, "part long, node long, n long, version long, met long, label long")
    found = minhash._met_by_others(placed).collect()
    kept = {p: {r.node for r in found if r.part == p} for p in range(1, 6)}
    assert kept[1] == {0, 1, 2, 3, 90, 95} and not kept[2] and kept[3] == set(range(300, 340)) and kept[4] == {400, 401, 402, 403} and not kept[5]

    def pairs(members, leaders):
        return {(a[0], a[1], b[1]) for a in members for b in leaders if a[0] == b[0] and a[2] != b[2]}

    whole = set()
    for part in range(1, 6):
        members = sorted((r for r in rows if r[0] == part), key=lambda r: (-r[4], r[1]))
        first = members[: minhash.CROWDED if len(members) <= 3 * minhash.CROWDED else minhash.LEADERS]
        whole |= pairs([(r[0], r[1], r[5]) for r in members], [(r[0], r[1], r[5]) for r in first])
    assert pairs([(r.part, r.node, r.label) for r in found], [(r.part, r.node, r.label) for r in found if r.leads]) == whole
