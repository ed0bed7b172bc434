"""What both tokenizer operators know about a SentencePiece BPE model.

A sequence of pieces is the model's encoding of their text if, and only if, every two
neighbours are the encoding of theirs. So the encoding of a prefix ends in the one piece that
goes with the encoding of what is before it, and can be found from left to right.
"""

from __future__ import annotations

import collections
import functools
import re

import public_tokenizers
import sentencepiece

SPACE = "▁"
MODEL = "piece_bpe_32k.model"


class Pieces:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.longest = max(map(len, self.ids))
        lengths: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], {1}).add(len(piece))
        #: by the last two characters, the lengths that a last piece can have
        self.endings = {k: tuple(sorted(v)) for k, v in lengths.items()}
        #: what each id stands for when decoded
        self.plain = [b""] * size
        for piece, i in self.ids.items():
            self.plain[i] = piece.replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.plain[i] = bytes([value])
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        if inner:
            raise ValueError("the model has pieces across spaces")
        stop = "" if "\n" in joined else "\n"
        #: parts that no piece crosses: spaces with what follows them, and line breaks
        self.parts = re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + (f"|{stop}" if stop else ""))
        self.size = size
        #: the number of no piece, after those of all characters
        self.start = size + 0x110000
        #: by the number of a piece, the pieces that were tried after it: their number, or -1 where they do not go
        self._follow: dict[int, dict[str, int]] = collections.defaultdict(dict)
        self._held = 0
        self._made: dict[str, tuple | None] = {}

    def normal(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """The encoding by definition: join the neighbours of highest score, the leftmost first. For a few characters."""
        parts = list(text)
        while (best := self._best(parts)) is not None:
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _best(self, parts: list[str]) -> tuple[float, int] | None:
        """The score and place of the next merge."""
        best = None
        for i in range(len(parts) - 1):
            score = self.scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best[0]):
                best = (score, i)
        return best

    def _number(self, piece: str) -> int:
        """The id of a piece; characters that the model lacks get numbers after all ids."""
        known = self.ids.get(piece)
        return self.size + ord(piece) if known is None else known

    def _extend(self, part: str, last: list[int], numbers: list[int]) -> None:
        """Continues, in place, the lengths and numbers of the last pieces of all prefixes of ``part``."""
        follow, endings, alone = self._follow, self.endings, (1,)
        for end in range(len(last), len(part) + 1):
            for length in endings.get(part[end - 2 : end] if end > 1 else "", alone):
                before = end - length
                if before < 0:
                    raise AssertionError("a prefix has no encoding")
                piece = part[before:end]
                number = follow[numbers[before]].get(piece)
                if number is None:
                    number = self._learned(numbers[before], part[before - last[before] : before], piece)
                if number >= 0:
                    last.append(length)
                    numbers.append(number)
                    break
            else:
                raise AssertionError("a prefix has no encoding")

    def _learned(self, before: int, left: str, right: str) -> int:
        """The number of ``right`` if it goes after ``left``, else -1; kept for the next time."""
        if self._held >= 1_000_000:  # memory stays bounded
            self._follow.clear()
            self._held = 0
        goes = (len(right) == 1 or right in self.ids) and self._goes(left, right)
        number = self._follow[before][right] = self._number(right) if goes else -1
        self._held += 1
        return number

    def _merges(self, piece: str) -> tuple[tuple, tuple] | None:
        """The scores of the merges that make ``piece``, in their order, with what begins it and what ends it
        before each and at the end; None if its encoding is not the piece alone."""
        known = self._made.get(piece, ())
        if known != ():
            return known
        parts = list(piece)
        scores, firsts, lasts = [], [parts[0]], [parts[-1]]
        while (best := self._best(parts)) is not None:
            score, i = best
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            scores.append(score), firsts.append(parts[0]), lasts.append(parts[-1])
        known = (tuple(scores), tuple(firsts), tuple(lasts)) if len(parts) == 1 else None
        if len(piece) > 1:  # single characters are cheap, and there may be many
            self._made[piece] = known
        return known

    def _goes(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` are what :meth:`merged` gives for both together.

        Until a merge crosses the border, each side merges as it would alone, so the two known rows of merges are
        passed in the order of their scores, and at each step the pair at the border is held against them.
        """
        b = self._merges(right)
        if not left or b is None:
            return b is not None
        a = self._merges(left)
        if a is None:
            return False
        (x, _, lasts), (y, firsts, _), i, j = a, b, 0, 0
        while True:
            across = self.scores.get(lasts[i] + firsts[j])
            on_left, on_right = i < len(x), j < len(y)
            # of equal scores the leftmost pair is first
            if across is not None and not (on_left and x[i] >= across) and not (on_right and y[j] > across):
                return False
            if on_left and not (on_right and y[j] > x[i]):
                i += 1
            elif on_right:
                j += 1
            else:
                return True

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of their text; ``left`` may be empty."""
        before = self._number(left) if left else self.start
        number = self._follow[before].get(right)
        return (self._learned(before, left, right) if number is None else number) >= 0

    def last_pieces(self, part: str) -> tuple[list[int], list[int]]:
        """For every prefix of ``part``, the length (0 for the empty prefix) and the number of the last piece of its encoding."""
        last, numbers = [0], [self.start]
        self._extend(part, last, numbers)
        return last, numbers

    def each_last_lengths(self, parts):
        """(part, its last lengths, the numbers of these pieces) for sorted ``parts``; what two neighbours begin with
        is computed once. A list holds until the next one is asked for."""
        before, last, numbers = "", [0], [self.start]
        for part in parts:
            same, most = 0, min(len(before), len(part))
            while same < most and before[same] == part[same]:
                same += 1
            del last[same + 1 :], numbers[same + 1 :]
            self._extend(part, last, numbers)
            before = part
            yield part, last, numbers

    def counts(self, part: str, last: list[int], numbers: list[int]) -> list[int]:
        """The number of ids of every prefix of ``part``, from the empty one on: that of the prefix before its last piece, and the piece's own."""
        size, out = self.size, [0]
        for end in range(1, len(part) + 1):
            out.append(out[end - last[end]] + (1 if numbers[end] < size else len(part[end - 1].encode())))
        return out

    def ids_of(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.bytes[b] for b in piece.encode()]

    def decoded(self, ids: list[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Memory:
    """Something known of each part, for the parts met last. Two generations bound it: what
    is met again moves to the new one, and the old one goes when the new one is full."""

    def __init__(self, make, size: int = 300_000):
        self.make, self.size, self.new, self.old = make, size, {}, {}

    def learn(self, model: Pieces, parts) -> dict:
        """A table that has all of ``parts``."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        missing = set(parts)
        missing.difference_update(self.new)
        for part in missing & self.old.keys():
            self.new[part] = self.old[part]
            missing.discard(part)
        for part, last, numbers in model.each_last_lengths(sorted(missing)):
            self.new[part] = self.make(model, part, last, numbers)
        return self.new


def text_groups(column, most: int = 1 << 20):
    """Texts of an Arrow column in lists of about ``most`` characters; NULL is empty."""
    group, size = [], 0
    for value in column:
        text = value.as_py() or ""
        group.append(text)
        size += len(text)
        if size > most:
            yield group
            group, size = [], 0
    if group:
        yield group


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def default_path() -> str:
    return public_tokenizers.path(MODEL)
