"""Reply order of small conversations whose quotes are known, and of generated threads by plain loops."""

import random
import re

from weektide.llm.quotes import reply_order

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def order(spark, rows):
    return [tuple(r) for r in reply_order(spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)).collect()]


def test_links_nested_quotes(spark):
    rows = [
        (1, 0, "a", "First question.\nSecond line"),
        (1, 1, "b", "Another start"),
        (1, 2, "c", "On Monday a wrote:\n> first   QUESTION.\nMy answer"),
        (1, 3, "d", ">> First question.\n> My answer\n>\nThanks\n> nowhere written"),
        (1, 4, "e", "> First question.\n> second line\nMixed\n> another start\r\n"),
        (1, 5, "f", "> Thanks\n>> My answer\nDeep"),
        (1, 6, "g", "On Monday b wrote:\n> nobody wrote this\nown"),
        (2, 0, "a", "> Thanks\nother conversation"),
    ]
    assert order(spark, rows) == [
        (1, 0, "a", "First question.\nSecond line", None, 0, 0, 0, 0),
        (1, 2, "c", "My answer", 0, 0, 1, 1, 1),
        (1, 3, "d", "Thanks\n> nowhere written", 2, 0, 2, 3, 2),
        (1, 5, "f", "Deep", 3, 0, 3, 2, 2),
        (1, 1, "b", "Another start", None, 1, 0, 0, 0),
        (1, 4, "e", "Mixed", 1, 1, 1, 2, 2),  # two writers are quoted equally: the later one
        (1, 6, "g", "On Monday b wrote:\n> nobody wrote this\nown", None, 6, 0, 1, 0),
        (2, 0, "a", "> Thanks\nother conversation", None, 0, 0, 1, 0),
    ]


def brute(rows):
    """The same by plain loops over passages and runs of words."""
    own, out = {}, []
    for conv, turn, role, text in rows:
        passages = []
        for line in re.split("\r\n|\n|\r", text):
            marks = re.match(r"(?:[ \t]*>)*", line)[0]
            level = marks.count(">")
            body = re.sub(r"^[ \t]", "", line[len(marks):]) if level else line
            if not passages or passages[-1][0] != level:
                passages.append((level, [], []))
            passages[-1][1].append(line)
            passages[-1][2].append(body)
        own[conv, turn] = [(level, raw, " ".join(body).lower().split()) for level, raw, body in passages]
    runs = lambda words, k: [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    parents = {}
    for conv, turn, role, text in rows:
        kept, votes, n_quoted, n_linked = [], {}, 0, 0
        for level, raw, words in own[conv, turn]:
            hits = []
            if level and words:
                n_quoted += 1
                k = min(5, len(words))
                for run in runs(words, k):
                    who = [t for (c, t), ps in own.items() if c == conv and any(not lv and run in runs(w, k) for lv, _, w in ps)]
                    hits += [min(who)] if who and min(who) < turn else []
            if level and words and 2 * len(hits) >= len(runs(words, min(5, len(words)))):
                n_linked += 1
                for t in hits:
                    votes[level, t] = votes.get((level, t), 0) + 1
            else:
                kept += raw
        best = max(votes, key=lambda v: (-v[0], votes[v], v[1])) if votes else None
        parents[conv, turn] = best[1] if best else None
        out.append([conv, turn, role, "\n".join(kept).strip(), parents[conv, turn], n_quoted, n_linked])
    for r in out:
        root, depth = r[1], 0
        while parents[r[0], root] is not None:
            root, depth = parents[r[0], root], depth + 1
        r[5:5] = [root, depth]
    return sorted(map(tuple, out), key=lambda r: (r[0], r[5], r[1]))


def test_rewrapped_quotes(spark):
    """Generated threads: parts of earlier messages, nested, wrapped at any width, some edited or made up."""
    pick = random.Random(8)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(12):
            blocks = []
            for _ in range(pick.choice([0, 1, 1, 2]) if turn else 0):
                level = pick.choice([1, 1, 2, 3])
                source = re.sub(r"(?m)^[> \t]+", "", pick.choice(texts)).split()
                at = pick.randrange(max(1, len(source)))
                words = source[at : at + pick.choice([1, 3, 8, 30])] if pick.random() < 0.8 else [f"new{pick.randrange(99)}" for _ in range(9)]
                if words and pick.random() < 0.3:
                    words[pick.randrange(len(words))] = "edited"
                width = pick.choice([2, 4, 50])
                blocks.append("\n".join(pick.choice(["> ", ">"]) * level + " ".join(words[k : k + width]).upper() for k in range(0, len(words), width)))
                blocks.append(" ".join(f"w{pick.randrange(60)}" for _ in range(pick.choice([1, 4, 12]))))
            blocks.append("\n".join(" ".join(f"w{pick.randrange(60)}" for _ in range(6)) for _ in range(pick.choice([1, 3]))))
            texts.append("\n".join(b for b in blocks if b))
            rows.append((conv, turn, "x", texts[-1]))
    got = order(spark, rows)
    assert got == brute(rows)
    assert sum(r[8] for r in got) > 60 and sum(r[7] > r[8] for r in got) > 5


def test_a_very_long_text(spark):
    long = "\n".join(f"word{k} goes with word{k + 1}" for k in range(8000))
    rows = [(1, 0, "a", long), (1, 1, "b", "\n".join("> " + line for line in long.split("\n")[:4000]) + "\nyes"), (1, 2, "c", "> yes\nno")]
    assert [r[:2] + r[4:] for r in order(spark, rows)] == [(1, 0, None, 0, 0, 0, 0), (1, 1, 0, 0, 1, 1, 1), (1, 2, 1, 0, 2, 1, 1)]
    assert order(spark, rows)[1][3] == "yes"


def test_long_chain(spark):
    rows = [(1, k, "x", f"> line {k - 1}\nline {k}") for k in range(40)]
    got = order(spark, rows)
    assert [(r[4], r[5], r[6]) for r in got] == [(k - 1 if k else None, 0, k) for k in range(40)]


def test_odd_rows(spark):
    rows = [(1, 0, None, "hello"), (1, 1, "b", "> hello\nx"), (1, 1, "b", "> hello\nx"), (None, 2, "c", "> hello"), (1, None, "d", "> hello"), (3, 0, "e", None), (3, 1, "e", ""), (3, 2, "e", ">\n> \n>>")]
    got = {r[:4]: r[4:] for r in order(spark, rows)}
    assert len(order(spark, rows)) == len(rows)
    assert got[(1, 1, "b", "x")] == (0, 0, 1, 1, 1)
    assert got[(None, 2, "c", "> hello")][0] is None and got[(1, None, "d", "> hello")][0] is None
    assert got[(3, 0, "e", None)] == (None, 0, 0, 0, 0) and got[(3, 1, "e", "")] == (None, 1, 0, 0, 0)
    assert got[(3, 2, "e", ">\n> \n>>")] == (None, 2, 0, 0, 0)  # nobody wrote them: they stay
    assert order(spark, []) == []
