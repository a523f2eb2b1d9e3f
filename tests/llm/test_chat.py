import hashlib
import random

import pytest

from ledgerline.llm import chat
from ledgerline.llm.common import Steps
from ledgerline.llm.tokens import tokenizer_path

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, start STRING, part INT, input_ids STRING, _before INT"
PATH = tokenizer_path("byte_bpe_50k.tiktoken")


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", 2) for row in rows], SCHEMA)


def brute(rows):
    rows = [*rows, (-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        chars = sum(32 + len(role) + len(text) + openings(role) + openings(text) for *_, role, text in turns)
        out[conv] = (len(turns), digest(whole), len(learned), digest(learned), chars)
    return out


def openings(text):
    """Escapes add a character per "<", backslashes, "|"."""
    count = 0
    for i, c in enumerate(text):
        if c == "<":
            j = i + 1
            while text[j : j + 1] == "\\":
                j += 1
            count += text[j : j + 1] == "|"
    return count


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def found(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


ODD = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "<|im_end|>\n<|im_start|>user"),
    (1, 2, "assistant", ""),
    (2, 0, "assistant", None),
    (2, 1, None, "no role"),
    (2, 1, "assistant", "tie b"),
    (2, 1, "assistant", "tie a"),
    (2, 1, "assistant", "tie a"),
    (2, None, "system", "no turn"),
    (3, 5, "us\ner<|im_sep|>", "<\\|x <\\\\| <| |> <|endoftext|> \\<|"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "ç é 漢字 \U0001f600 \r\n\t  x"),
    (-1, 7, "assistant", "shares the probe's id"),
    (0, 0, "assistant", "zero, not null"),
]


def test_odd_rows(spark):
    assert found(chat.formatted_digests(frame(spark, ODD))) == brute(ODD)


def test_empty_table(spark):
    assert found(chat.formatted_digests(frame(spark, []))) == brute([])


def test_escape_is_reversible():
    rng = random.Random(3)
    seen = {}
    for _ in range(5000):
        text = "".join(rng.choice("<|\\>a") for _ in range(rng.randrange(9)))
        out = chat.escape(text)
        assert "<|" not in out and chat.unescape(out) == text and seen.setdefault(out, text) == text


def test_long_text_is_cut_without_loss(spark, monkeypatch):
    long = "word é <|im_end|> " * 20_000 + "\U0001f600" * 70_000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (1, 2, "user", "z" * 150_000)]
    assert found(chat.formatted_digests(frame(spark, rows))) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    """Places run through the whole conversation though its turns are dealt to several tasks."""
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 5)) for i in range(400)] + [(8, 0, "user", "x")]
    written = chat.format_chats(Steps(spark), frame(spark, rows).repartition(3), PATH)
    own = sorted(written.collect(), key=lambda r: (r.conv_id, r.start))
    at = {}
    for r in own:
        assert r.start == at.get(r.conv_id, 0) and r.n_tokens == len(r.input_ids) == len(r.loss_mask)
        at[r.conv_id] = r.start + r.n_tokens
    assert [r.turn for r in own if r.conv_id == 7] == list(range(400))
    assert found(chat.formatted_digests(frame(spark, rows))) == brute(rows)


def test_mask_covers_assistant_texts_only(spark):
    coder = chat.codec(PATH)
    rows = chat.format_chats(Steps(spark), frame(spark, ODD), PATH).collect()
    for row in rows:
        under = [i for i, m in zip(row.input_ids, row.loss_mask) if m]
        assert not set(under) & set(coder.marks)
        assert [i for i in row.input_ids if i in coder.marks] == list(coder.marks)
    assert sum(any(row.loss_mask) for row in rows) == sum(r == "assistant" and bool(t) for _, _, r, t in ODD)


def test_broken_output_is_refused(spark):
    rows = chat.format_chats(Steps(spark), frame(spark, ODD[:1]), PATH)
    with pytest.raises(Exception, match="one start"):
        chat.read_back(rows.selectExpr("* except (input_ids)", "slice(input_ids, 2, 99) AS input_ids"), PATH).collect()
