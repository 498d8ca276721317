"""What Python workers keep and take: they stand beside an executor's heap, and five stages of the pipeline share them."""

import ctypes
import subprocess
import sys

import public_tokenizers
import pytest

from telemark.llm import op05_packing

_KEPT = """
import re
from telemark.llm import common

def mb():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024

before = mb()
made = [bytes([k % 256]) * 1000 for k in range(200_000)]
pins = made[::500]  # what lies above freed memory keeps the C library from giving it back by itself
common.worker_cache("pieces", lambda: made)
del made
full = mb()
{change}
print(before, full, mb())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux") or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="memory is read and given back as on Linux with glibc")
@pytest.mark.parametrize("change", ["common.drop_worker_cache()", "common.worker_cache('other', dict)"])
def test_workers_give_back_what_an_operator_kept(change):
    run = subprocess.run([sys.executable, "-c", _KEPT.format(change=change)], capture_output=True, text=True, check=True, timeout=120)
    before, full, after = map(int, run.stdout.split())
    assert full - before > 150
    assert after - before < 50


class _Recorded:
    def __init__(self, tokenizer, sizes):
        self.tokenizer, self.sizes = tokenizer, sizes

    def encode_batch_fast(self, texts, **options):
        self.sizes.append(sum(max(1, len(t.split())) for t in texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_the_library_encodes_a_bounded_number_of_words_at_once():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = op05_packing.WordEncoder(f.read())
    library, sizes = words.tokenizer, []
    words.tokenizer, words.plain = (t and _Recorded(t, sizes) for t in (words.tokenizer, words.plain))
    letters = ["".join(chr(97 + k // 26**j % 26) for j in range(4)) for k in range(9000)]
    texts = [" ".join(letters), " ".join(f"{x}{k}" for k, x in enumerate(letters)), " ".join(f"{x}," for x in letters)]
    found = words.encode([t.encode() for t in texts])
    assert max(sizes) <= 4096
    assert sum(sizes) >= 18_000
    for text, ids in zip(texts, found, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == expected
