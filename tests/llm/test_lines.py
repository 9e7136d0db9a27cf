import random

import pytest

from tests.llm.helpers import linked_classes, prose
from tierline.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out)) if out else 0
        kind = rng.random()
        if kind < 0.3 and out:
            del out[k]
        elif kind < 0.6:
            out.insert(k, rng.choice("abc"))
        elif out:
            out[k] = rng.choice("abc")
    return "".join(out)


def test_distance_and_probes_equal_the_full_table():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, rng.randint(0, 4))
        for k in (0, 1, 2, 3):
            near = distance(a, b) <= k
            assert lines.within(a, b, k) == near
            if near and min(len(a), len(b)) > k:
                short, long = sorted((a, b), key=len)
                own = {key for key, o in lines.probes(short, k) if o}
                assert own & {key for key, _ in lines.probes(long, k)}


@pytest.mark.parametrize("block", [1024, 2])
def test_repeats_equal_all_pairs(documents, block):
    rng = random.Random(3)
    base = [prose(k, 12) for k in range(12)]
    texts = ["\n".join(edited(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 3))) for _ in range(4)) for _ in range(25)]
    texts += [None, "", "short\nshort", texts[3]]
    places = {}
    for d, text in enumerate(texts):
        for i, line in enumerate((text or "").split("\n")):
            if len(line) >= lines.MIN_CHARS:
                places.setdefault(line, []).append((d, i))
    names = sorted(places)
    near = lines.MIN_NEAR_CHARS
    classes = linked_classes(names, lambda a, b: min(len(a), len(b)) >= near and distance(a, b) <= 2)
    groups = {}
    for name in names:
        groups.setdefault(classes[name], []).extend(places[name])
    expected = {p for g in groups.values() for p in g if p != min(g)}
    found = lines.repeated_lines(documents(texts), block_lines=block).collect()
    assert {(r["doc_id"], r["line_no"]) for r in found} == expected
    exact = {p for g in places.values() for p in g if p != min(g)}
    assert {(r["doc_id"], r["line_no"]) for r in found if r["exact"]} == exact


def test_short_lines_repeat_as_well(documents):
    rng = random.Random(5)
    short = [" ".join(rng.choice(("le", "ab", "cab", "Les.", "én")) for _ in range(n)) for n in (1, 2, 2, 3, 3, 4, 4, 5, 6, 8)]
    texts = ["\n".join(edited(rng, rng.choice(short), rng.choice((0, 0, 1, 2))) for _ in range(6)) for _ in range(40)]
    texts += ["Les.\nDer eingeä erer.\n}\nEn.", "Les.\nDer, eingeä erer.\n}\nUn.", " \n\n", "abcdefg", "abcdefh", "abcdefgh", "abcdefgi"]
    places = {}
    for d, text in enumerate(texts):
        for i, line in enumerate(text.split("\n")):
            if line.strip():
                places.setdefault(line.strip(), []).append((d, i))
    # Nothing is too short to repeat; one edit for every eight code points, two at most.
    classes = linked_classes(sorted(places), lambda a, b: distance(a, b) <= min(2, min(len(a), len(b)) // 8))
    groups = {}
    for line, at in places.items():
        groups.setdefault(classes[line], []).extend(at)
    found = {(r["doc_id"], r["line_no"]) for r in lines.repeated_lines(documents(texts)).collect()}
    assert found == {p for g in groups.values() for p in g if p != min(g)}
    assert {(41, 0), (41, 1), (41, 2)} <= found and not {(41, 3), (44, 0)} & found


def test_removal_keeps_columns_and_first_lines(documents, awkward):
    line = "this line stands in two documents and is long enough"
    docs = documents([f"first\n{line}", f"{line}\nown words of the second", line, "", None])
    kept = {r["doc_id"]: r for r in lines.drop_repeated_lines(docs).collect()}
    assert set(kept) == {0, 1, 3, 4}
    assert kept[0]["text"] == f"first\n{line}" and kept[1]["text"] == "own words of the second"
    assert kept[1]["n_chars"] == len(kept[1]["text"]) and kept[4]["text"] is None
    out = lines.drop_repeated_lines(awkward)
    assert out.columns == awkward.columns and out.count() > 0
    assert lines.report(awkward).count() == awkward.count()
    assert lines.drop_repeated_lines(awkward.limit(0)).count() == 0
