import random

from basketflow.llm import line_dedup, queries
from tests.llm.conftest import SF_DIR


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def varied(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out) + 1)
        out[at:at + rng.choice([0, 1])] = rng.choice(["", "x", "é", "\U0001f600"])
    return "".join(out)


def brute(pairs, edits=2, least=24):
    places = [(i, k, line) for i, t in pairs for k, line in enumerate((t or "").split("\n"))]
    lines = sorted({line for _, _, line in places if len(line) >= least})
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                root[find(a)] = find(b)
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    keep = {}
    for i, k, line in places:
        if len(line) >= least:
            keep[find(line)] = min(keep.get(find(line), (i, k)), (i, k), key=order)
    out = {}
    for i, k, line in places:
        n, dropped = out.get(i, (0, set()))
        out[i] = (n + 1, dropped | ({k} if len(line) >= least and (i, k) != keep[find(line)] else set()))
    return sorted([(i, n, len(d), sorted(d)) for i, (n, d) in out.items()], key=repr)


def test_band_equals_full_matrix():
    rng = random.Random(5)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("abé", k=rng.choice([0, 1, 3, 30, 90])))
        pairs.append((a, varied(rng, a, rng.choice([0, 1, 2, 3, 5]))))
    for edits in (0, 1, 2, 3):
        got = line_dedup.distances([a for a, _ in pairs], [b for _, b in pairs], edits).tolist()
        assert got == [min(distance(a, b), edits + 1) for a, b in pairs]


def test_classes_equal_brute_force(docs, edges, rows):
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdefgh ", k=rng.choice([5, 23, 24, 26, 60, 61]))) for _ in range(25)]
    pairs = []
    for i in range(60):
        lines = [varied(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.choice([0, 1, 3, 6]))]
        pairs.append((i + 100, "\n".join(lines)))
    pairs += [(i, t if t is None or len(t) < 2000 else t[:2000]) for i, t in edges if i is not None]
    got = line_dedup.dropped_lines(docs(pairs), shortest=line_dedup.LEAST)
    merged = {}
    for i, t in pairs:
        merged.setdefault(i, []).append(t)
    single = [(i, t[0]) for i, t in merged.items()]
    frame = docs(single)
    assert rows(line_dedup.dropped_lines(frame, shortest=line_dedup.LEAST)) == brute(single)
    assert got.count() == len(merged)
    stripped = line_dedup.strip_lines(frame)
    assert stripped.columns == frame.columns and stripped.count() == len(single)
    again = line_dedup.dropped_lines(stripped)
    assert again.where("n_dropped > 0").count() == 0


def test_query_finds_exact_repeats(spark, shared, real):
    got = {r.doc_id: r for r in queries.op8_line_dedup(spark, SF_DIR).collect()}
    assert len(got) == len(real)
    seen = set()
    for i, text in sorted(real):
        for k, line in enumerate((text or "").split("\n")):
            if line in seen and len(line) >= line_dedup.LEAST:
                assert k in got[i].dropped
            seen.add(line)
    assert line_dedup.dropped_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_are_grouped_by_equality(docs, rows):
    long = "a line that is long enough for edits"
    pairs = [(1, "menu\nhome\n\nmenu\n" + long), (2, "menu\nmenus\n\nHome\n" + long + "s"), (3, "x\nx\n\n"), (4, None)]
    assert rows(line_dedup.dropped_lines(docs(pairs), shortest=1)) == [
        (1, 5, 1, [3]), (2, 5, 2, [0, 4]), (3, 4, 1, [1]), (4, 1, 0, [])]


def test_query_drops_every_repeat_of_a_short_line(spark, shared, real):
    got = {r.doc_id: r for r in queries.op8_line_dedup(spark, SF_DIR).collect()}
    seen = set()
    for i, text in sorted(real):
        for k, line in enumerate((text or "").split("\n")):
            if 0 < len(line) < line_dedup.LEAST:
                assert (k in got[i].dropped) == (line in seen)
                seen.add(line)


def test_rows_of_one_identifier_keep_their_own_lines(spark, shared):
    """Repeated and null identifiers, row by row; extra columns have inner names."""
    a, b, c, d = (f"a line that is long enough, number {w}" for w in ("first and foremost", "two, which differs", "3", "the fourth of these lines"))
    rows = [(7, f"{a}\n{b}"), (7, f"{c}\n{d}"), (8, a), (None, f"{b}\nonly here, with the null identifier"), (None, f"short\n{d}"), (9, "short\nshort"), (10, None)]
    docs = spark.createDataFrame([(i, t, k, "x", "y", "z") for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, n int, _dropped string, _id string, line_key string").repartition(3)
    got = line_dedup.strip_lines(docs)
    assert got.columns == docs.columns
    text = {r.n: r.text for r in got.collect()}
    # nulls come first: they keep b, d and "short"; row 7 keeps a and c
    assert text == {0: a, 1: c, 2: "", 3: rows[3][1], 4: rows[4][1], 5: "", 6: None}


def test_a_very_long_pair_needs_little_memory():
    import resource

    long = "x" * 200_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert line_dedup.distances([long], ["y" + long], 2).tolist() == [1]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000


def test_verified_pairs_of_very_different_lengths(spark, shared):
    pairs = [(k, k + 1000, "a" * n, "a" * (n - 1) + "b") for k, n in enumerate([30, 50_000, 31, 300_000] + [40] * 700)]
    pairs.append((5000, 6000, "a" * 90, "b" * 90))
    frame = spark.createDataFrame(pairs, "a long, b long, ta string, tb string").repartition(1)
    assert {r.a for r in line_dedup._verified(frame, 2).collect()} == {p[0] for p in pairs[:-1]}
