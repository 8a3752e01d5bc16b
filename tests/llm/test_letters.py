"""What token counts take for letters and numbers, over all of Unicode, against the tokenizers library."""

import pyarrow as pa
import pytest
import regex

public_tokenizers = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402
from tokenizers.pre_tokenizers import ByteLevel  # noqa: E402

from tickloom.llm import token_counts  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_every_code_point_is_cut_as_by_the_library():
    """Every character, assigned or not, at the start of a word, within one, beside digits, signs and blanks. The exact
    pattern holds for all; the plain one wherever no newer letter occurs."""
    newer = token_counts.newer_letters()
    exact, plain = regex.compile(token_counts.older_pattern(newer)), regex.compile(token_counts.PATTERN)
    library, odd = ByteLevel(add_prefix_space=False, use_regex=True), set(newer)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for new in (True, False):
        some = [c for c in points if (c in odd) == new]
        for i in range(0, len(some), 2000):
            text = "".join(f" a{c}1{c} {c}.{c}" for c in some[i : i + 2000])
            ends = [end for _, (_, end) in library.pre_tokenize_str(text)]
            assert [m.end() for m in (exact if new else plain).finditer(text)] == ends


def test_counts_with_newer_letters():
    newer = token_counts.newer_letters()
    texts = [f"word{c}s and 12{c}3, {c}{c} alone {c}" for c in newer[:: len(newer) // 40 + 1]] + ["plain é text", "", None]
    with open(BPE, encoding="utf-8") as file:
        vocabulary = file.read()
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    (out,) = token_counts.counted(iter([batch]), vocabulary, newer)
    library = Tokenizer.from_file(BPE)
    assert out.column(2).to_pylist() == [len(x.ids) for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_newer_letters_are_no_common_ones():
    newer = token_counts.newer_letters()
    assert len(set(newer)) == len(newer) and not any(c.isascii() for c in newer)
    assert not set("éßяñ日本語٣５") & set(newer)
