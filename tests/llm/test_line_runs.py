"""Line dedup against plain loops, and what must hold of any result."""

import random

import pytest
import xxhash
from helpers import by_id, frame, prose

from clickmeter.llm import linededup


def borders(lines):
    """Starts of chunks by the rule, for lines that all have a word."""
    roll = lambda a, b: (3 * a + b) * 0x9E3779B97F4A7C15 % 2**64
    h = [xxhash.xxh3_64_intdigest(x.encode()) for x in lines]
    value = [-1] + [roll(h[i - 1], h[i]) for i in range(1, len(h))] + [-1]
    out = []
    for i in range(len(lines)):
        same = 0
        while i - same > 1 and value[i - same - 1] == value[i]:
            same += 1
        if i == 0 or value[i - 1] > value[i] < value[i + 1] or (same and value[i] == value[i + 1] and same % 2 == 0):
            out.append(i)
    return out


def plain_chunks(text):
    """Chunks as lists of the numbers of their lines."""
    lines = (text or "").split("\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    cuts = borders([lines[i] for i in full])
    return lines, [list(range(full[a], full[b - 1] + 1)) for a, b in zip(cuts, cuts[1:] + [len(full)], strict=True)] if full else []


def plain(texts):
    """Kept texts, and for each chunk that went where its equal is."""
    cut = [plain_chunks(t) for t in texts]
    words = lambda lines, c: sum(bool(lines[i].strip()) for i in c)
    content = lambda d, k: "\n".join(cut[d][0][i] for i in cut[d][1][k])
    places = {}
    for d, (lines, cs) in enumerate(cut):
        for k, c in enumerate(cs):
            if words(lines, c) > 1:
                places.setdefault(content(d, k), []).append((d, k))
    again = {c: p for c, p in places.items() if len(p) > 1}
    single = lambda d, k: not 0 <= k < len(cut[d][1]) or content(d, k) not in again
    kept, relied = [], []
    for d, (lines, cs) in enumerate(cut):
        goes = [not single(d, k) and again[content(d, k)][0] != (d, k) for k in range(len(cs))]
        gone = set()
        for k, c in enumerate(cs):
            if not goes[k]:
                continue
            gone |= set(c)
            if k and goes[k - 1]:
                gone |= set(range(cs[k - 1][-1], c[0]))
            e, j = again[content(d, k)][0]
            relied.append((d, e, content(d, k)))
            for step, order in ((-1, -1), (1, 1)):
                near, far = k + step, j + step
                if not (0 <= near < len(cs) and single(d, near) and 0 <= far < len(cut[e][1]) and single(e, far) and single(e, far + step)):
                    continue
                run = []
                for x, y in zip(cs[near][::order], cut[e][1][far][::order], strict=False):
                    if lines[x] != cut[e][0][y]:
                        break
                    run.append(x)
                if run:
                    gone |= set(range(min(run + c), max(run + c) + 1))
        kept.append(texts[d] if not texts[d] else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return kept, relied


def shared(seed):
    random_ = random.Random(seed)

    def own(n):
        return [" ".join(prose(random_, 9)) for _ in range(n)]

    runs, texts = [own(n) for n in (1, 2, 2, 3, 4, 6, 9, 14)], []
    runs += [[a, "", b, c, "", d] for a, b, c, d in (own(4), own(4))]
    for _ in range(40):
        lines = own(random_.randrange(3))
        for run in random_.sample(runs, 2):
            lines += run + own(random_.randrange(4)) + [""] * random_.randrange(2)
        texts.append("\n".join(lines))
    return texts


def dense(seed):
    """Few different lines: repeats overlap, within a text as well."""
    random_ = random.Random(seed)
    return ["\n".join(random_.choice(["a a", "b b", "c c", ""]) for _ in range(random_.randrange(14))) for _ in range(60)] + ["x\n" * 9, "x\n" * 30]


@pytest.mark.parametrize("texts", [shared(4), shared(5), dense(1), dense(2), ["a a\nb b\na a\nb b", "b b\na a"]])
def test_chunks_and_their_edges_go_as_by_plain_loops(spark, texts):
    expected, relied = plain(texts)
    got = by_id(linededup.stripped(frame(spark, texts)))
    assert [got[i]["text"] for i in range(len(texts))] == expected
    report = by_id(linededup.report(frame(spark, texts)))
    for i, text in enumerate(texts):
        assert report[i]["n_removed_lines"] == text.count("\n") + 1 - (expected[i].count("\n") + 1 if expected[i] or report[i]["n_removed_lines"] <= text.count("\n") else 0)
    # Whatever went stands, line by line, in the text it was said to equal.
    for _, e, content in relied:
        assert f"\n{content}\n" in f"\n{expected[e]}\n"


def test_the_last_copy_of_a_run_stays(spark):
    got = by_id(linededup.stripped(frame(spark, ["a a\nb b\na a\nb b", "b b\na a"])))
    whole = [got[i]["text"] for i in range(2)]
    assert any("b b\na a" in t for t in whole) and any("a a\nb b" in t for t in whole)


def test_passage_between_own_lines_goes(spark):
    """All but a line or two of it, wherever its borders lie."""
    random_ = random.Random(9)
    left = whole = 0
    for n in (8, 14, 30):
        passage = [" ".join(prose(random_, 9)) for _ in range(n)]
        own = [[" ".join(prose(random_, 9)) for _ in range(6)] for _ in range(30)]
        texts = ["\n".join(x[:3] + passage + x[3:]) for x in own]
        got = by_id(linededup.stripped(frame(spark, texts)))
        assert got[0]["text"] == texts[0]
        for i in range(1, 30):
            kept = got[i]["text"].split("\n")
            assert [x for x in kept if x not in passage] == own[i]
            left += len(kept) - 6
            whole += n
    assert left < 0.1 * whole


def test_borders_follow_the_content():
    random_ = random.Random(2)
    lines = [" ".join(prose(random_, 6)) for _ in range(400)]
    cut = linededup.chunks(lines)
    sizes = [b - a for a, b, _ in cut]
    assert min(sizes) == 2 and 2.7 < sum(sizes) / len(sizes) < 3.3 and len(set(sizes)) > 3
    assert [a for a, _, _ in cut] == borders(lines)
    # Lines put in front, or one changed, move the borders next to them only.
    front = {b - 3 for _, b, _ in linededup.chunks(["x", "y", "z"] + lines)}
    assert {b for _, b, _ in cut if b > 3} <= front
    changed = {a for a, _, _ in linededup.chunks(lines[:200] + ["other"] + lines[201:])}
    assert {a for a, _, _ in cut if abs(a - 200) > 3} == {a for a in changed if abs(a - 200) > 3}
