import random

WORDS = "the of and to in that was for on are with as his they at be this from have or by one had not".split()


def prose(seed, words):
    rng = random.Random(seed)
    out = []
    for k in range(words):
        w = rng.choice(WORDS) + rng.choice(("", "ing", "ed", "ly", "tion")) + rng.choice(("", "", str(rng.randint(0, 9))))
        out.append(w + ("." if k % 9 == 8 else ""))
    return " ".join(out)


def rows(texts):
    return [(i, t, "en", "s", len(t) if t else None) for i, t in enumerate(texts)]


def linked_classes(items, linked):
    """Least member reachable, by comparing all pairs."""
    head = {x: x for x in items}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                head[y] = x
    return {x: find(x) for x in items}
