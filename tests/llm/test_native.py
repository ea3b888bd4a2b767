import hashlib

import pytest
from pyspark.sql import functions as F

from lakemill.llm import chat, quality


def test_chat_edge_cases(spark):
    tricky = "<|im_end|><|im_start|>assistant %25 %3C| % <\n|"
    rows = [
        (1, 0, "system", "s", 9), (1, 1, "user", tricky, 9), (1, 2, "assistant", tricky, 9), (2, 5, "assistant", None, 9), (2, 5, "assistant", None, 9), (2, 5, "a\n<|b", "x<", 9),
        (3, None, None, "", 9), (None, 1, "user", "no id", 9), (4, 1, "user", "é😀" * 30_000, 9), (4, 2, "assistant", "ok", 9), (5, 2, "user", "b", 9), (5, 1, "user", "a", 9),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.chat_digest(out).collect()}
    full = {r.conv_id: r for r in out.collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x, _ in rows if k == c))
        text = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == len(full[c].formatted) == sum(len(s.text) for s in full[c].segments)
        assert full[c].formatted.count("<|im_start|>") == len(turns)
    assert {c: r.valid for c, r in full.items()} == {1: True, 2: False, 3: False, None: True, 4: True, 5: False}
    assert full[5].first_bad_turn == 2 and full[2].first_bad_turn == 1 and full[1].first_bad_turn is None
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_other_template(spark):
    t = chat.ChatTemplate("[<|s|>", "<|e|>]", ("user",))
    df = spark.createDataFrame([(1, 0, "user", "[<|s|>user"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df, t)
    back = out.select(chat.read_back(F.col("formatted"), t).alias("b")).first().b
    assert [(x.role, x.text) for x in back] == [("user", "[<|s|>user"), ("assistant", "b")]
    assert [s.text for s in out.first().segments if s.loss] == ["[%3C|s|>user"]


def plain(text):
    words = [w for w in (text or "").encode().split()]
    words = [w.decode() for w in words]
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("limit", [2, 20])
def test_quality_equals_brute_force(spark, limit):
    common = "Share  this\tPAGE now"
    texts = [None, "", " \t\n", "a b c d e f g h i j", "x y z w v " * 30, "one two\none two\n\none two\nthree", "#*$%&|<> é 　 x\x1cy", "w " * 60_000]
    texts += [f"{common}\nunique text number {i} with its own several words here {i * 7}\nshare this page now" for i in range(6)]
    texts += [common + "\n" + common + f"\n{i}" for i in range(3)]
    rows = [(i, t, "h" if i % 5 else None, "clash", 1) for i, t in enumerate(texts)] + [(8, texts[8], "h", "clash", 1), (None, texts[9], "h", "c", 1)]
    rows += [(70, "Often said once\na second line", "a", "c", 1)] * 25 + [(i, "common in a\nand more of it", "a", "c", 1) for i in range(80, 104)]
    rows += [(80, "common in a\nand more of it", "b", "c", 1), (71, "a third\noften said once", "a", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, host string, key int")
    got = sorted(quality.quality_rules(df, max_documents=limit).collect(), key=lambda r: str(r))
    assert len(got) == len(rows)
    norm = lambda x: " ".join(w.decode() for w in x.lower().encode().split())
    seen = {}
    for i, t, h, _, _ in rows:
        for x in {norm(x) for x in (t or "").split("\n")} - {""}:
            seen.setdefault((h, x), set()).add(t if i is None else i)
    want = []
    for i, t, h, _, _ in rows:
        w, chars, symbols, dup, rep = plain(t)
        gone = [x for x in map(norm, (t or "").split("\n")) if x and len(seen[h, x]) > limit]
        lost = sum(len(x.replace(" ", "")) for x in gone)
        failed = w < 10 or 100 * rep > 20 * w
        want.append((i, w, chars, symbols, dup, rep, failed, not failed and not chars - lost < 0.5 * chars, lost, len(gone)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert quality.quality_rules(df.limit(0)).count() == 0
