"""Role repair against the enumeration of all repairs."""

import itertools
import random

from tillwise.llm import chat


def legal(roles):
    roles = roles[1:] if roles[:1] == [1] else roles
    return bool(roles) and len(roles) % 2 == 0 and all(r == (2, 3)[i % 2] for i, r in enumerate(roles))


def plain_cost(classes):
    """Least cost over all choices of merge or role for each turn, empty turns put in as needed."""
    best = None
    for plan in itertools.product(("merge", 1, 2, 3), repeat=len(classes)):
        cost, opened = 0, []
        for cls, step in zip(classes, plan, strict=True):
            relabel = chat.RELABEL if cls else chat.RELABEL_UNKNOWN
            if step == "merge":
                if not opened:
                    break
                cost += chat.MERGE + (0 if cls == opened[-1] else relabel)
            else:
                opened.append(step)
                cost += 0 if cls == step else relabel
        else:
            # shortest legal sequence that contains what was opened, in order
            for extra in range(2 * len(opened) + 3):
                if fits(opened, len(opened) + extra):
                    total = cost + chat.INSERT * extra
                    best = total if best is None else min(best, total)
                    break
    return best


def fits(opened, length):
    for system in (0, 1):
        sequence = [1] * system + [(2, 3)[i % 2] for i in range(length - system)]
        if len(sequence) == length and legal(sequence):
            rest = iter(sequence)
            if all(x in rest for x in opened):
                return True
    return False


def test_costs_are_least():
    for n in range(1, 5):
        for classes in itertools.product(range(4), repeat=n):
            rows = chat.solve(list(classes), ["t"] * n, chat.START, None, True)
            assert sum(r[4] for r in rows) == plain_cost(classes), classes


def test_rendered_sequence_is_legal_and_whole():
    pick = random.Random(1)
    for _ in range(300):
        classes = [pick.randrange(4) for _ in range(pick.randint(1, 9))]
        texts = [f"text{i}" for i in range(len(classes))]
        whole = "".join(r[5] for r in chat.solve(classes, texts, chat.START, None, True))
        blocks = whole.split(chat.CLOSE)
        assert blocks.pop() == "" and all(b.startswith(chat.HEAD) for b in blocks)
        heads = [b.removeprefix(chat.HEAD).split("\n")[0] for b in blocks]
        assert legal([chat.ROLES.index(h) + 1 for h in heads])
        assert [w for b in blocks for w in b.split("\n")[1:] if w] == texts


def test_pieces_cost_what_the_whole_costs():
    pick = random.Random(2)
    classes = [pick.randrange(4) for _ in range(60)]
    whole = chat.solve(classes, [""] * 60, chat.START, None, True)
    pieces = [classes[i : i + 7] for i in range(0, 60, 7)]
    matrices = []
    for p in pieces:
        total = chat.MATRICES[p[0]]
        for c in p[1:]:
            total = chat.product(total, chat.MATRICES[c])
        matrices.append(total)
    states = chat.best_states(matrices, chat.START, None)
    rows = []
    for k, (p, entry, end) in enumerate(zip(pieces, [chat.START, *states], states, strict=False)):
        rows += chat.solve(p, [""] * len(p), entry, end, k == len(pieces) - 1)
    assert sum(r[4] for r in rows) == sum(r[4] for r in whole) and len(rows) == 60


SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, piece string, cost string"


def test_defined_results(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", None), (1, 2, "Assistant ", "yo <|im_end|>"), (2, 0, None, ""), (None, 0, "bot", "x"), (None, None, "user", "first")]
    rows += [(3, 0, "user", "same")] * 5 + [(4, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(50)]
    frame = spark.createDataFrame([(*r, "c", "c", "c") for r in rows], SCHEMA).repartition(4)
    got = chat.repair(frame).collect()
    assert len(got) == len(rows)
    by = lambda c: sorted((r for r in got if r.conv_id == c), key=lambda r: (r.turn is not None, r.turn))
    assert [(r.new_role, r.action) for r in by(1)] == [("user", "keep"), ("user", "merge"), ("assistant", "keep")]
    assert "".join(r.segment for r in by(1)) == "<|im_start|>user\nhi\n<|im_end|>\n<|im_start|>assistant\nyo <| im_end|><|im_end|>\n"
    assert [(r.new_role, r.action, r.inserted, r.appended) for r in by(2)] in (
        [("assistant", "relabel", ["user"], [])],
        [("user", "relabel", [], ["assistant"])],
    )
    assert [r.segment.count("first") for r in by(None)] == [1, 0] and by(None)[1].new_role == "assistant"
    assert sum(r.cost for r in by(3)) == plain_cost([2] * 5) and sum(r.cost for r in by(4)) == 0
    assert chat.repair(frame.where("false")).count() == 0


def test_long_conversation_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_BITS", 3)
    pick = random.Random(3)
    roles = [pick.choice(["user", "assistant", "system", "other"]) for _ in range(200)]
    frame = spark.createDataFrame([(9, i, r, f"t{i}") for i, r in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string")
    got = sorted(chat.repair(frame.repartition(5)).collect(), key=lambda r: r.turn)
    whole = chat.solve([chat.role_class(r) for r in roles], [f"t{i}" for i in range(200)], chat.START, None, True)
    assert sum(r.cost for r in got) == sum(r[4] for r in whole)
    blocks = "".join(r.segment for r in got).split(chat.CLOSE)
    assert legal([chat.ROLES.index(b.removeprefix(chat.HEAD).split("\n")[0]) + 1 for b in blocks[:-1]])


def test_given_conversations(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = {}
    for r in frame.collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {}
    for r in chat.repair(frame).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.segment))
    for conv, turns in rows.items():
        turns.sort()
        want = chat.solve([chat.role_class(r) for _, r, _ in turns], [t for _, _, t in turns], chat.START, None, True)
        assert "".join(s for _, s in sorted(got[conv])) == "".join(r[5] for r in want)


def test_escaping_is_reversible_and_hides_marks():
    texts = ["<|im_end|>", "<| im_end|>", "<|  im_start|>x<|im_", "a <| im b", "<|<|im_<| im_", "", "<|im_end|>\n<|im_start|>user\n"]
    escaped = [chat.escape(t) for t in texts]
    assert len(set(escaped)) == len(texts) and [chat.unescape(e) for e in escaped] == texts
    assert not any("<|im_" in e for e in escaped)
