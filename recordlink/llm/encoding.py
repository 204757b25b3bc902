"""Token ids of whole texts by a public tokenizer file, with a cache of word results.

Both supported tokenizers cut a text into words that never cross white space, and encode
each word on its own. So a batch of texts is cut at blanks by Arrow, each distinct chunk of the
batch is looked up or goes once through the tokenizers library, and the texts' ids are put
together from the chunks' ids with numpy. Where runs of white space matter to the tokenizer, a
text is cut by the tokenizer's own word pattern instead. Texts with characters beyond Latin-1 or
control separators go whole through the library. The result is the library's, id for id.
"""

from __future__ import annotations

from recordlink.llm.common import give_back, worker_held


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def text_encoder(path: str, cache_words: int = 600_000, block_bytes: int = 1 << 22):
    """``encode(texts) -> list of bytes``: each text's ids, little-endian unsigned 16-bit; null
    texts are empty. ``texts`` is an Arrow array or a list.

    ``path`` names a ``tokenizers`` file: byte-level BPE, with or without the lower-casing,
    blank-dropping front end. The cache holds the words met last, in two halves of ``cache_words / 2``:
    when the newer is full it becomes the older one, whose words move up as they are met again. So
    memory is bounded (about 200 bytes a word); the cache lives in the Python worker until
    another operator runs in it. Texts are encoded in blocks of about ``block_bytes``, one text at
    least; a block takes some ten to twenty times its size.
    """
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = worker_held("encoders")
    key = path, cache_words, block_bytes
    if key not in made:
        made[key] = _make_encoder(*key)
        give_back()         # what reading the file took
    return made[key]


def _make_encoder(path: str, cache_words: int, block_bytes: int):
    import itertools
    import re
    from array import array

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(path)
    full.encode_special_tokens = True
    if full.get_vocab_size() > 65536:
        raise ValueError("ids are kept in 16 bits; the vocabulary has more than 65536 entries")
    words_only = full.normalizer is not None
    # The words are cut here, so the per-word tokenizer keeps only the byte mapping and merges: the
    # same vocabulary in memory, with the file's added tokens.
    one = Tokenizer(full.model)
    for _, token in sorted(full.get_added_tokens_decoder().items()):
        (one.add_special_tokens if token.special else one.add_tokens)([token])
    one.encode_special_tokens = True
    one.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters, digits, blank = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r\x20\x85\xa0"
    short = "'s|'t|'re|'ve|'m|'ll|'d"
    if words_only:
        cut = re.compile(rf"{short}|[{letters}]+|[{digits}]|[^{blank}{letters}{digits}]+")
        special = None
    else:
        cut = re.compile(rf"{short}| ?[{letters}]+| ?[{digits}]+| ?[^{blank}{letters}{digits}]+"
                         rf"|[{blank}]+(?![^{blank}])|[{blank}]+")
        # Blank runs, other white space, or white space at an end: the word pattern decides.
        special = r"[\t-\r\x20]{2}|[\t\x0b\x0c\r]|\x{85}|\x{a0}|^[\x20\n]|[\x20\n]$"
    foreign = r"[^\x{0}-\x{ff}]|[\x1c-\x1f]"
    # A letter, a comma or full stop, then white space: always three words, so cut there at once.
    stop, stopped = r"([A-Za-zÀ-ÖØ-öø-ÿ])([,.])([\x20\n])", r"\1 \2\3" if words_only else "\\1\x1f\\2\\3"
    cache: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def ids_for(chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, from the cache or the library."""
        nonlocal cache, older
        got = list(map(cache.get, chunks))
        at = [i for i, v in enumerate(got) if v is None]
        if at:
            known, several = {}, {}         # words; the words of chunks that may hold more than one
            for i in at:
                c = chunks[i]
                if c[1:].isalpha() if not words_only and c[:1] == " " else c.isalpha():
                    known[c] = None
                else:
                    several[i] = cut.findall(c)
            if older:
                known.update(zip(known, list(map(older.get, known))))
            for w in itertools.chain.from_iterable(several.values()):
                if w not in known:
                    known[w] = cache.get(w) or older.get(w)
            todo = [w for w, v in known.items() if v is None]
            for i in range(0, len(todo), 4096):     # the library's results are large
                some = todo[i:i + 4096]
                made = one.encode_batch_fast(some, add_special_tokens=False)
                known.update(zip(some, [array("H", e.ids).tobytes() for e in made]))
            if len(cache) + len(known) > cache_words // 2:
                cache, older = {}, cache
            cache.update(known)
            for i in at:
                got[i] = b"".join([known[w] for w in several[i]]) if i in several else known[chunks[i]]
        return got

    def joined(chunks: pa.Array, ends) -> list[bytes]:
        """Ids of texts given as runs of chunks: text i is ``chunks[ends[i]:ends[i + 1]]``."""
        coded = chunks.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        parts = ids_for(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(parts), "<u2")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
        first = np.cumsum(size) - size
        n = size[codes]
        after = np.cumsum(n)
        at = np.repeat(first[codes] - (after - n), n)
        at += np.arange(len(at))
        data, stops = flat[at].tobytes(), (2 * np.concatenate([[0], after])[ends]).tolist()
        return [data[a:b] for a, b in zip(stops, stops[1:])]

    def encode_block(texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        alien = pc.match_substring_regex(texts, foreign)
        plain = pc.invert(alien)
        if special is not None:
            plain = pc.and_not(plain, pc.match_substring_regex(texts, special))
        kind = np.where(plain.to_numpy(zero_copy_only=False), 0, np.where(alien.to_numpy(zero_copy_only=False), 2, 1))
        out: list[bytes] = [b""] * len(texts)
        rows = np.flatnonzero(kind == 0)
        if len(rows):
            some = texts.take(pa.array(rows)) if len(rows) < len(texts) else texts
            some = pc.replace_substring_regex(some, stop, stopped)
            if words_only:
                split = pc.utf8_split_whitespace(pc.utf8_lower(some))
            else:
                # a blank starts the next word, a newline stands alone
                some = pc.replace_substring(pc.replace_substring(some, " ", "\x1f "), "\n", "\x1f\n\x1f")
                split = pc.split_pattern(some, "\x1f")
            ends = split.offsets.to_numpy()
            for r, x in zip(rows.tolist(), joined(split.values.slice(ends[0], ends[-1] - ends[0]), ends - ends[0])):
                out[r] = x
        rows = np.flatnonzero(kind == 1)
        if len(rows):
            words = [cut.findall(texts[r].as_py()) for r in rows.tolist()]
            ends = np.cumsum([0, *map(len, words)])
            for r, x in zip(rows.tolist(), joined(pa.array([w for ws in words for w in ws], pa.string()), ends)):
                out[r] = x
        for r in np.flatnonzero(kind == 2).tolist():
            out[r] = array("H", full.encode(texts[r].as_py(), add_special_tokens=False).ids).tobytes()
        return out

    def encode(texts) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        out, at = [], 0
        while at < len(texts):
            size = np.cumsum(pc.fill_null(pc.binary_length(texts.slice(at, 4096)), 0).to_numpy(zero_copy_only=False))
            k = max(1, int(np.searchsorted(size, block_bytes)))
            out += encode_block(texts.slice(at, k))
            at += k
        return out

    return encode


def ids_of(data: bytes):
    """The ids as a numpy array of little-endian unsigned 16-bit integers."""
    import numpy as np
    return np.frombuffer(data, "<u2")


def crc_of(ids) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib
    return zlib.crc32(ids.astype("<u4").tobytes())
