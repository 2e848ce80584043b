"""SentencePiece encoding and decoding by a table of last tokens.

Merging by rank gives every text one token sequence. It follows that each prefix of a text has
one last token: the one matching token that is compatible with the last token of what stands
before it. The codec fills that table from left to right, with candidates from an Aho-Corasick
automaton over the pieces, and reads the ids off backwards. Whether two tokens may stand side by
side is decided by undoing their merges from the latest to the earliest and looking for a merge
across the border that would have come first.

Nothing merges across a pair of characters that no piece holds side by side, so a text is cut
there and each cut-out stretch is encoded once per task and kept in a table of bounded size.

Defined results: a null text counts as empty; an empty text has the end id only; characters
without a piece become byte tokens; ids that are control or unknown decode to nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.common import mapped, unused

SPACE = "▁"
#: Stretches whose ids a task keeps, and their characters with those of the ids; beyond it the table
#: starts anew, results stay the same. Longer ones than LONGEST_KEPT are not kept at all.
KEPT_STRETCHES = 300_000
KEPT_CHARACTERS = 24_000_000
LONGEST_KEPT = 400
NEVER = 1 << 60


class PieceCodec:
    """Encode and decode with the pieces and scores of a model file."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.vocab_size()
        self.end_id = model.eos_id()
        self.surface = [b""] * size
        self.byte_ids = [0] * 256
        self.id_of: dict[str, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id_of[piece] = i
                self.surface[i] = piece.replace(SPACE, " ").encode()
        scores = {i: model.get_score(i) for i in self.id_of.values()}
        order = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Rank of the merge that makes a token; single characters are made by no merge.
        self.rank = {i: -1 if len(p) == 1 else order[scores[i]] for p, i in self.id_of.items()}
        self.last_merge: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        runs = {p for p in self.id_of if set(p) == {SPACE}}
        self.run_lengths = {len(p) for p in runs}
        if len({scores[self.id_of[p]] for p in runs}) > 1:
            raise ValueError("pieces of spaces must share one score")
        self._learn_merges(runs)
        self._automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if i in self.last_merge:
                self._automaton.add_word(piece, (i, len(piece)))
        self._automaton.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._stretch = self._cut_pattern()
        self._ids: dict[str, str] = {}
        self._held = 0
        self._bytes_of = {str(i): b for i, b in enumerate(self.surface)}

    # -- tables -------------------------------------------------------------------------------

    def _learn_merges(self, runs: set[str]) -> None:
        """The last merge of every token that merging can make; other pieces never occur."""
        for piece in sorted(self.id_of, key=len):
            i = self.id_of[piece]
            if len(piece) == 1:
                self.last_merge[i] = (i, i)
            elif piece not in runs:
                parts = self._merge(piece)
                if parts:
                    self.last_merge[i] = parts
        for i, (left, right) in self.last_merge.items():
            if self.rank[i] >= 0:
                self.merged[left, right] = i
        # Any two tokens that spell a piece can merge, not only the pair that usually does.
        for piece, i in self.id_of.items():
            if len(piece) > 1 and piece not in runs:
                for cut in range(1, len(piece)):
                    left, right = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                    if left is not None and right is not None:
                        self.merged[left, right] = i

    def _merge(self, piece: str) -> tuple[int, int] | None:
        """The pair merged last when the piece is spelt from characters, None if it isn't made."""
        parts = list(piece)
        while len(parts) > 2:
            best, at = NEVER, -1
            for n in range(len(parts) - 1):
                made = self.id_of.get(parts[n] + parts[n + 1])
                if made is not None and self.rank[made] < best:
                    best, at = self.rank[made], n
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        ids = [self.id_of.get(p) for p in parts]
        return None if None in ids else (ids[0], ids[1])

    def _cut_pattern(self) -> re.Pattern:
        """Stretches that merge with nothing outside: spaces lead, marks stand apart from letters.

        The second form holds only if no piece has a letter beside such a mark; the pieces tell.
        """
        pieces = list(self.id_of)
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds a space behind other characters")
        beside = {m for p in pieces for m in re.findall(r"(?<=[^\W\d_])[^\w▁]", p)}
        before = {m for p in pieces for m in re.findall(r"[^\w▁](?=[^\W\d_])", p)}
        marks = "".join(re.escape(c) for c in ".,;:!?%&$*#|\n" if c not in beside and c not in before)
        after = "".join(re.escape(c) for c in ".,;:!?%&$*#|\n" if c not in beside)
        letters = r"[^\W\d_▁]"
        forms = [rf"{SPACE}*{letters}+(?=[{after}])"] if after else []
        forms += [rf"[{marks}]+(?={letters})"] if marks else []
        forms += [r"\n+"] if not any("\n" in p for p in pieces) else []
        others = r"[^▁\n]" if len(forms) and forms[-1] == r"\n+" else r"[^▁]"
        return re.compile("|".join([*forms, rf"{SPACE}*{others}+", rf"{SPACE}+"]))

    # -- encoding -----------------------------------------------------------------------------

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens side by side."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > 4 * KEPT_STRETCHES:
                self._fits.clear()
            known = self._fits[left, right] = self._undo(left, right)
        return known

    def _undo(self, left: int, right: int) -> bool:
        rank, limit = self.rank, NEVER
        while True:
            made = self.merged.get((left, right))
            if made is not None and rank[made] < limit:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                # A merge across the border at the same rank stands further right, so it is later.
                limit, left = rank[left], self.last_merge[left][1]
            else:
                limit, right = rank[right] + 1, self.last_merge[right][0]

    def _known(self, text: str) -> list[int]:
        """Ids of characters that all have a piece."""
        last: list[int] = [-1] * (len(text) + 1)
        width = [0] * (len(text) + 1)
        fits, fitting = self._fits, self.fits
        for end, (token, size) in self._automaton.iter(text):
            end += 1
            if width[end]:
                continue
            start = end - size
            if start:
                before = last[start]
                ok = fits.get((before, token))
                if not (fitting(before, token) if ok is None else ok):
                    continue
            last[end], width[end] = token, size
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= width[at]
        ids.reverse()
        return ids

    def _run(self, count: int) -> list[int]:
        """Pieces of spaces share one score, so the leftmost pair that spells a piece merges first."""
        grown: list[int] = []
        for _ in range(count):
            grown.append(1)
            while len(grown) > 1 and grown[-2] + grown[-1] in self.run_lengths:
                grown[-2:] = [grown[-2] + grown[-1]]
        return [self.id_of[SPACE * n] for n in grown]

    def _encode_stretch(self, stretch: str) -> list[int]:
        word = stretch.lstrip(SPACE)
        spaces = len(stretch) - len(word)
        if not word:
            return self._run(spaces)
        ids: list[int] = []
        text, lone = SPACE * (spaces > 0) + word, self.id_of[SPACE]
        start = 0
        for at, char in enumerate(text):
            if char not in self.id_of:
                if at > start:
                    ids += self._known(text[start:at])
                ids += [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
                start = at + 1
        if start < len(text):
            ids += self._known(text[start:])
        if spaces > 1:
            alone = ids[0] == lone
            ids = self._run(spaces - (not alone)) + ids[alone:]
        return ids

    def encode_joined(self, text: str | None) -> str:
        """Decimal ids joined by one space, the end id last."""
        if not text:
            return str(self.end_id)
        known, parts = self._ids, []
        for stretch in self._stretch.findall(SPACE + text.replace(" ", SPACE)):
            ids = known.get(stretch)
            if ids is None:
                ids = " ".join(map(str, self._encode_stretch(stretch)))
                if len(stretch) <= LONGEST_KEPT:
                    self._held += len(stretch) + len(ids)
                    if self._held > KEPT_CHARACTERS or len(known) >= KEPT_STRETCHES:
                        known.clear()
                        self._held = len(stretch) + len(ids)
                    known[stretch] = ids
            parts.append(ids)
        parts.append(str(self.end_id))
        return " ".join(parts)

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for i in self.encode_joined(text).split(" ")]

    # -- decoding -----------------------------------------------------------------------------

    def decode_joined(self, ids: str) -> bytes:
        """The text of ids as :meth:`encode_joined` writes them, in UTF-8."""
        out = b"".join(map(self._bytes_of.__getitem__, ids.split(" "))) if ids else b""
        out = out[1:] if out[:1] == b" " else out
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode("utf-8", "replace").encode()
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_joined(" ".join(map(str, ids))).decode()


@lru_cache(maxsize=2)
def codec(model_path: str) -> PieceCodec:
    """One codec per process and model file."""
    return PieceCodec(model_path)


def encode_documents(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of each row with ``n_tokens``, ``ids`` (decimal, joined by a space) and
    ``decoded`` text.

    Rows stay where they are: no shuffle, and a task holds one Arrow batch of texts.
    """
    keep = docs.columns if keep is None else keep
    return _map_texts(docs, model_path, text, keep, "n_tokens long, ids string, decoded string", _whole)


def digest_documents(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """As :func:`encode_documents`, with SHA-256 digests in place of ids and decoded text."""
    keep = docs.columns if keep is None else keep
    return _map_texts(docs, model_path, text, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _whole(coder: PieceCodec, text: str | None) -> tuple:
    ids = coder.encode_joined(text)
    return ids.count(" ") + 1, ids, coder.decode_joined(ids).decode()


def _digests(coder: PieceCodec, text: str | None) -> tuple:
    ids = coder.encode_joined(text)
    return (
        ids.count(" ") + 1,
        hashlib.sha256(ids.encode()).hexdigest(),
        hashlib.sha256(coder.decode_joined(ids)).hexdigest(),
    )


def _map_texts(docs: DataFrame, model_path: str, text: str, keep: list[str], added: str, work) -> DataFrame:
    added_names = [part.split(" ")[0] for part in added.split(", ")]
    keep = [c for c in keep if c.lower() not in added_names]
    inner = unused(docs, "__text")
    rows = docs.select(*[docs[c] for c in keep], docs[text].alias(inner))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != inner)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model_path)
        for frame in frames:
            texts = frame.pop(inner)
            made = [work(coder, t) for t in texts]
            for n, name in enumerate(added_names):
                frame[name] = [m[n] for m in made]
            yield frame

    return mapped(rows, run, f"{kinds}, {added}" if kinds else added)
