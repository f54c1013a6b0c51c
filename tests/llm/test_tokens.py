import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odd_texts import ODD
from tripmart.llm import bpe, tokencount

R = random.Random(11)
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "a" * 5000, " " * 3000, "\n\n  x", "<|endoftext|>hi<|endoftext|>", "İΣΑΣ ΟΔΟΣ ǅ", "e\u0301 A\u030a", "日本語テキスト 漢字", "'s don't We'LL",
    "\x1c\x1d a\x85b c", "😀👍🏽 x", "²½ ٣", "<|startoftext|>A <|ENDOFTEXT|>", "ab" * 3000, "of the " * 900, "\u3000x　y", "<|endoftext|", "\U0010ffff\ue000",
]


def _random_texts():
    out = ["".join(R.choice("aeiou thsn\n\t'’éÉß<|>0123!?\u0301Σ漢😀 ") for _ in range(R.randint(1, 400))) for _ in range(200)]
    parts = ["a", "b", "the", "ing", "zz", " ", "  "]
    return out + ["".join(R.choice(parts[: R.randint(1, 7)]) for _ in range(2000)) for _ in range(40)]


TEXTS = [*ODD, *HARD, *_random_texts()]


def test_token_counts_match_the_library(docs_of):
    library = Tokenizer.from_file(WORD)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    for r in tokencount.token_counts(docs_of(TEXTS, extra=True), WORD).collect():
        text = TEXTS[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), want[r["doc_id"]], want[r["doc_id"]] > 2048)
    assert tokencount.token_counts(docs_of([]), WORD).count() == 0


def test_leftmost_rounds_count_the_same():
    merger = tokencount.Merger(WORD)
    words = [bytes(R.choice(b"aeinst") for _ in range(R.randint(1, 60))) for _ in range(300)]
    together = merger.merge_counts(words)
    merger.ordered = False
    assert (together == merger.merge_counts(words)).all()


def test_ids_and_text_match_the_library(docs_of):
    library = Tokenizer.from_file(BYTE)
    encoded = bpe.encode(docs_of(TEXTS, extra=True), BYTE)
    for r in bpe.decode(encoded, BYTE).collect():
        want = library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["text"] == library.decode(want, skip_special_tokens=False) == (TEXTS[r["doc_id"]] or "")


@pytest.mark.parametrize("alphabet", ["a", "ab", "the in", "=-", " \n", "0123456789", "aeiounst "])
def test_windows_emit_only_stable_tokens(alphabet):
    """With the smallest windows, the streamed tokens are those of the whole piece."""
    t = bpe.Transducer(BYTE)
    t.window = max(map(len, t.bytes_of))
    for _ in range(30):
        raw = "".join(R.choice(alphabet) for _ in range(R.randint(200, 3000))).encode()
        assert [i for ids in t.stream(raw) for i in ids] == t.merge(raw)


def test_decoder_state_spans_steps():
    t = bpe.Transducer(BYTE)
    text = "é漢😀" * 50
    ids = np.array([t.byte[b] for b in text.encode()], dtype="<u4").tobytes()
    assert t.decode(ids, step=1) == text
    broken = np.array([t.byte[0xF0], t.byte[0x9F], t.byte[0x41]], dtype="<u4")
    assert t.decode(broken.tobytes(), step=1) == Tokenizer.from_file(BYTE).decode(broken.tolist(), skip_special_tokens=False)


def test_one_pass_answers_as_two(docs_of):
    docs = docs_of(TEXTS[:120])
    two = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()}
    assert {r["doc_id"]: r for r in bpe.transcode(docs, BYTE).collect()} == two


def test_digests_of_empty_tables(docs_of):
    assert bpe.round_trip(docs_of([])).count() == 0
    assert {r["n_tokens"] for r in bpe.round_trip(docs_of([None, ""])).collect()} == {0}


def test_small_memories_and_steps_give_the_same_ids(monkeypatch):
    library, t = Tokenizer.from_file(BYTE), bpe.transducer(BYTE)
    monkeypatch.setattr(bpe, "TOGETHER", 50)
    monkeypatch.setattr(bpe, "LONG", 300)
    memory = bpe.Memory(room=20)
    for _ in range(2):
        got = t.encode_all(TEXTS, memory)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(x or "", add_special_tokens=False).ids for x in TEXTS]
    assert len(memory.young) + len(memory.old) <= 2 * (20 + 50)


def test_pieces_met_again_stay_in_memory():
    memory = bpe.Memory(room=10)
    for i in range(100):
        memory.keep({"often": b"1"} | {f"{i}-{k}": b"2" for k in range(3)})
        assert memory.known({"often"}) == {"often": b"1"} and len(memory.young) + len(memory.old) < 30


def test_pieces_merged_together_as_one_by_one():
    t = bpe.transducer(BYTE)
    raws = ["".join(R.choice("aeiouthsnr é日") for _ in range(R.randint(1, 40))).encode() for _ in range(500)]
    want = [np.array(t.merge(r), "<u4").tobytes() for r in raws]
    assert t.merge_together(list(raws)) == want
    t.ordered = False
    assert t.merge_together(list(raws)) == want
    t.ordered = True


def test_memory_of_a_long_text():
    """Beside a text of 30 MB the encoder holds a small multiple of it."""
    import tracemalloc

    t, text = bpe.transducer(BYTE), "the quick brown fox jumps over one lazy dog and " * 650_000
    tracemalloc.start()
    t.encode_all([text], bpe.Memory())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(text)
