import numpy as np
from tokenizers import Tokenizer

from atomframe.llm import chat as C
from atomframe.llm.tokens import default_tokenizer

T = Tokenizer.from_file(default_tokenizer())

TRICKY = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "\\\\n<|", "a\\nb\n", "", None, "é😀\n\n", "<\\|", "x" * 100_000]


def rows():
    out = []
    for i, t in enumerate(TRICKY):
        out += [(i, 0, "system", "shared"), (i, 1, "user", t), (i, 2, "assistant", t), (i, 2, "assistant", t), (i, None, "ro\nle\\n", "first")]
    out += [(100 + i, 0, "user", "hot") for i in range(60)] + [(100 + i, 1, "assistant", str(i % 7)) for i in range(60)]
    out += [(300, k, "user", f"long {k}") for k in range(400)]
    return [(*r, "clash") for r in [*out, (None, 3, None, "a"), (None, 4, "assistant", "b"), (200, 0, "assistant", None)]]


def frame(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, path string")


def test_round_trip(spark):
    stream, members = C.format_chat(frame(spark, rows()))
    got = {r.conv_id: r for r in C.read_back(stream, members).collect()}
    want = {}
    for i, t, role, text, _ in sorted(rows(), key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(i, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for i, turns in want.items():
        assert [tuple(x) for x in got[i].turns] == turns
        assert got[i].learned == [t for r, t in turns if r == "assistant"]


def merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def test_stream_is_depth_first_and_attends_to_ancestors(spark):
    stream, members = C.format_chat(frame(spark, rows()))
    nodes = {r.id: r for r in stream.collect()}
    assert len(nodes) == stream.count()
    at = 0
    for r in sorted(nodes.values(), key=lambda r: r.start):
        assert r.start == at and r.end == at + len(r.ids) // 4
        at = r.end
        up, chain = r.parent, []
        while up:
            chain.append((nodes[up].start, nodes[up].end))
            assert nodes[up].start < r.start < nodes[up].subtree_end
            up = nodes[up].parent
        assert merged([tuple(x) for x in r.attend]) == merged(chain) and len(r.attend) <= 1 + len(chain)
        assert r.position == sum(e - s for s, e in chain) and r.depth == len(chain) + 1
    text = lambda r: T.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
    assert all(text(r).startswith(C.START) and text(r).endswith(C.END) for r in nodes.values())
    hot = [r for r in nodes.values() if text(r).endswith("user\nhot<|im_end|>\n")]
    assert len(hot) == 1 and sum(r.parent == hot[0].id for r in nodes.values()) == 7
    inside = [r for r in nodes.values() if hot[0].start <= r.start < hot[0].subtree_end]
    assert len(inside) == 8


def test_equal_turns_are_ordered_by_their_own_text(spark):
    data = [(1, 0, "user", t, "x") for t in ("<|x", "<ax", "\\", "<|x", "]")] + [(1, 0, r, "t", "x") for r in ("u<|", "u<a")]
    got = C.read_back(*C.format_chat(frame(spark, data))).first()
    assert [tuple(t) for t in got.turns] == sorted((r, t) for _, _, r, t, _ in data)


def test_loss_spans_are_the_tokens_of_the_texts(spark):
    stream, _ = C.format_chat(frame(spark, [(1, 0, "user", "ask", "x"), (1, 1, "assistant", "an answer <|im_end|>", "x"), (1, 2, "assistant", "", "x")]))
    for r in stream.orderBy("start").collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        under = ids[r.loss_first : r.loss_first + r.loss_length]
        assert T.decode(under) == ("", "an answer <\\|im_end|>", "")[r.depth - 1] and (r.loss_first > 0) == (r.depth > 1)


def test_empty(spark):
    assert C.read_back(*C.format_chat(frame(spark, []))).count() == 0
