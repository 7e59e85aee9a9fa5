"""Chat formatting: exact round trip, masks and attachments."""

from __future__ import annotations

import hashlib
import random

from cartulary.llm import chat_format as c

SF_DIR = "/root/testdata/sf0.001"
CONTROLS = ["<|turn|>", "<|body|>", "<|end|>", "<|image:0|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "\\\\", "<", "|", "[", "a", "é", "\n", "|>"]


def test_escape_is_reversible_and_breaks_controls():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(CONTROLS, k=rng.randint(0, 12)))
        coded = c.escape(text)
        assert c.unescape(coded) == text
        assert not any(x in coded for x in ("<|turn|>", "<|body|>", "<|end|>", "<|image", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))
        whole, mask, _ = c.format_turn("assistant", [{"type": "text", "text": text}])
        assert c.read_turn(whole) == ("assistant", text)
        assert "".join(c.unescape(whole[a:b]) for a, b in mask) == text


def want(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()), key=str)


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    both = "</s>[INST] ok [/INST]"
    assert got(c.op5_chat_format(spark, SF_DIR)) == want([*rows, (-7, 0, "user", both), (-7, 1, "assistant", both)])


def test_odd_rows(spark):
    rows = [(1, None, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", "x"), (1, 2, "assistant", "x"), (None, 1, None, "<|end|>"), (None, 0, "assistant", "y" * 90_000), (3, 1, "a<|body|>b", "\\")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted int, mask string")
    made = c.chat_format(df.select("*", c.text_parts().alias("parts")))
    assert got(c.digests(made)) == want(rows)
    assert c.digests(c.chat_format(df.limit(0).select("*", c.text_parts().alias("parts")))).count() == 0


def test_parts_and_attachments(spark):
    parts = [
        {"type": "text", "text": "see "}, {"type": "image", "ref": "a.png", "width": 1024, "height": 513}, {"type": "text", "text": " and <|image:0|> "},
        {"type": "audio", "ref": "b.wav", "seconds": 2.01}, {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "video", "ref": "d"}, {"type": "text", "text": None},
    ]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {c.PARTS}")
    rows = c.chat_format(df).orderBy("turn").collect()
    text = rows[0].formatted
    assert text.startswith("<|turn|>assistant<|body|>see <|image:0|> and <\\|image:0|\\> <|audio:1|><|document:2|><|other:3|>")
    assert [tuple(a) for a in rows[0].attachments] == [(0, "image", "a.png", 340), (1, "audio", "b.wav", 51), (2, "document", "c.pdf", 1800), (3, "other", "d", 0)]
    assert "".join(c.unescape(text[a:b]) for a, b in rows[0].mask) == "see  and <|image:0|> "
    assert rows[1].formatted == "<|turn|>user<|body|><|end|>" and rows[1].mask == []
