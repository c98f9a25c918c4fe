import hashlib
import random

from mise.llm import line_dedup as X


def brute(rows, min_lines=3, min_words=50):
    """By the definition: every run of enough lines or words that occurs earlier goes, in the order of ids."""
    docs = []
    for doc_id, text in sorted(rows):
        lines = (text or "").split("\n")
        real = [i for i, line in enumerate(lines) if line.encode().split()]
        docs.append((doc_id, lines, real, [" ".join(x.decode() for x in lines[i].encode().split()) for i in real]))
    seen, out = {}, {}
    for doc_id, lines, real, norm in docs:
        gone = set()
        for at in range(len(norm)):
            words = 0
            for end in range(at + 1, min(len(norm), at + 12) + 1):
                words += len(norm[end - 1].split(" "))
                if end - at < min_lines and words < min_words:
                    continue
                first = seen.setdefault(tuple(norm[at:end]), (doc_id, at))
                if first != (doc_id, at):
                    start = max(at, first[1] + end - at) if first[0] == doc_id else at
                    gone.update(real[start:end])
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(norm), len(gone))
    return out


def sample(seed=4):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(["a", "bb", "c  c", "dé"]) + str(rng.randrange(9)) for _ in range(rng.choice([1, 3, 12, 60]))) for _ in range(60)]
    rows = []
    for i in range(80):
        at = rng.randrange(50)
        part = lines[at:at + rng.randint(0, 8)] + [rng.choice(lines) for _ in range(rng.randint(0, 5))] + [""] * rng.randint(0, 2)
        rows.append((i, "\n".join(part)))
    return rows + [(200, None), (201, ""), (202, "x\n" * 4000), (203, "\n \n\t"), (204, lines[0] * 2000), (205, lines[0] * 2000)]


def test_matches_brute_force(frame):
    rows = sample()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_deleted"]) for r in X.without_runs(frame(rows)).collect()}
    assert got == brute(rows)
    assert sum(v[2] for v in got.values()) > 20


def test_same_windows_share_a_fingerprint():
    text = "\n".join(f"line {i} {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(9))
    inner = {(c, m) for _, _, c, m in X.windows_of(text)}
    outer = {(c, m) for _, _, c, m in X.windows_of("one\ntwo\n" + text + "\nend")}
    assert inner <= outer


def test_short_lines_behind_a_long_one_go_too(frame):
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(1, long + "\nshort one"), (2, long + "\nshort one"), (3, long), (4, "before\n" + long + "\nshort one\nafter"),
            (5, "x y\n" + other), (6, "x y\n" + other), (7, "q\nshort one"), (8, "x y\n" + other[:-1])]
    got = {r["doc_id"]: (r["n_deleted"], r["text"]) for r in X.without_runs(frame(rows)).collect()}
    assert {d: n for d, (n, _) in got.items()} == {1: 0, 2: 2, 3: 1, 4: 2, 5: 0, 6: 2, 7: 0, 8: 0}
    assert got[4][1] == "before\nafter"


def test_extension_follows_any_earlier_place(frame):
    """The earliest place of the long line isn't the one that the short line follows in."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, long + "\nshort"), (3, long + "\nshort"), (4, "short")]
    assert {r["doc_id"]: r["n_deleted"] for r in X.without_runs(frame(rows)).collect()} == {1: 0, 2: 1, 3: 2, 4: 0}


def test_odd_inputs(frame, empty):
    assert X.without_runs(empty).count() == 0
    run = "first line\nsecond line\nthird line"
    rows = [(1, run), (1, run), (None, run), (None, run + "\nmore")]
    got = sorted(((r["doc_id"], r["n_deleted"]) for r in X.without_runs(frame(rows)).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 3), (None, 3)], key=str)
