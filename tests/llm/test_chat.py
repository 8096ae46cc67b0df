import hashlib
import random
import re

from tablewright.llm.chat import _Turn, _Windows, escape, format_chats, parse_window, read_chats, unescape


def digest(turns):
    turns = sorted(turns, key=lambda t: tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in t))
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_control_strings_are_reversible():
    for text in ("\\### Assistant: </turn> ok", "###", "\\", "\\\\<", "a\n### b: c</turn>\n", ""):
        assert unescape(escape(text)) == text


def test_windows_repeat_history_and_mask_it(spark):
    turns = [(1, 0, "system", "be brief")] + [
        (1, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * (30 if k != 6 else 900)) for k in range(1, 30)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    windows = [w.asDict() for w in format_chats(frame, budget=200, history=80).orderBy("window_no").collect()]
    assert len(windows) > 5
    texts = {}
    for w in windows:
        parsed = parse_window(w["text"])
        assert len(parsed) == w["n_context"] + w["n_turns"] and w["n_turns"] >= 1
        assert parsed[0] == ("system", "be brief")
        # Only a turn that is over the budget together with the system turn may break it.
        assert w["n_tokens"] <= 200 or (w["n_turns"], w["n_context"]) == (1, 1)
        for span in w["loss_spans"]:
            text = unescape(w["text"][span["start"]:span["end"]])
            texts[text] = texts.get(text, 0) + 1
    assert any(w["n_context"] > 1 for w in windows[1:])
    assert texts == {t: 1 for _, _, r, t in turns if r == "assistant"}


def test_windows_keep_the_budget_for_all_lengths():
    """Random turns of many lengths: every window within the budget, but for single turns that cannot be."""
    rnd = random.Random(3)
    for trial in range(300):
        budget = rnd.choice([10, 50, 200])
        history = rnd.choice([0, 5, budget // 2, budget, 3 * budget])
        lengths = [rnd.choice([1, rnd.randint(1, budget), rnd.randint(1, 2 * budget)]) for _ in range(rnd.randint(1, 40))]
        turns = [_Turn("system" if k == 0 and trial % 2 else rnd.choice(["user", "assistant"]), f"<{k}>", 0, n) for k, n in enumerate(lengths)]
        state, rows = _Windows(1, budget, history), []
        for turn in turns:
            context = list(state.context)
            closed = state.add(turn)
            rows += [closed] if closed else []
            assert state.context in (context, state.context) and state.new[-1] is turn
        rows.append(state.close())
        system = lengths[0] if turns[0].role == "system" else 0
        at = 0
        for w in rows:
            names = [int(n) for n in re.findall(r"<(\d+)>", w["text"])]
            new = names[w["n_context"]:]
            assert new == list(range(at, at + w["n_turns"])) and w["n_tokens"] == sum(lengths[n] for n in names)
            over = w["n_tokens"] > budget
            assert not over or (len(new) == 1 and lengths[new[0]] + (system if at else 0) > budget and w["n_context"] <= 1)
            repeated = names[:w["n_context"]]
            if at:
                assert not system or repeated[0] == 0
                kept = repeated[1:] if system else repeated
                assert kept == list(range(at - len(kept), at)) and sum(lengths[n] for n in kept) <= history
            at += w["n_turns"]
        assert at == len(turns)


def test_digests_match_the_table(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, 3, None, "x\n### y: </turn>"),
             (2, None, "assistant", "é" * 5000), (None, 0, "user", ""), (3, 0, "assistant", "\\### Assistant: </turn> ok"),
             (4, 0, "system: a\n", "<b>\\")]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, window_no string")
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
             for r in read_chats(format_chats(frame, budget=64, history=16, partitions=3)).collect()}
    assert found == {c: digest([t[1:] for t in turns if t[0] == c]) for c in {t[0] for t in turns}}
    assert read_chats(format_chats(frame.limit(0))).count() == 0
