"""URL filtering with a bit-parallel wildcard automaton.

Glob patterns are packed one after the other into the bits of a multiword
Shift-And automaton: bit i of the state says that the first i units of its
pattern have been read. One step per URL byte moves all patterns at once, and
a batch of URLs moves together, so the work per byte does not depend on how
many patterns share a machine word.

Globs: ``*`` is any run of bytes but ``/``, ``**`` any run, ``?`` one byte but
``/``; a backslash makes the next character plain.

A site rule (host, path) fits its host and all subdomains when the URL's path
starts with the rule's path. It becomes the globs ``host/path**`` and
``*.host/path**`` over the canonical URL (lower-case host, then path). The
longest fitting rule decides (the earlier one of equally long rules). Where
no rule fits, the URL is blocked if a block glob matches and allowed if none
does.

A null URL, or one without ``://``, has an empty host and path and fits no
rule. Repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm import common

SCHEMA = "page_id long, host string, path string, rule string, verdict string"

# (verdict, host, path): the site rules of the registered query
SITE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# hosts and paths blocked where no site rule fits
BLOCK_GLOBS = ["*cheap-pills*/**", "*casino*/**", "*free-money*/**", "*xxx*/**", "**/spam/**"]

SLASH = ord("/")


class GlobSet:
    """Shift-And masks of a list of globs over bytes."""

    def __init__(self, globs: list[str]):
        import numpy as np

        steps: list[tuple[int, object]] = []  # (bit, set of bytes that move it on)
        loops: list[tuple[int, bool]] = []  # (bit, whether "/" keeps it too)
        self.first, self.last, bit = [], [], 0
        for glob in globs:
            self.first.append(bit)
            data, i = glob.encode(), 0
            while i < len(data):
                c = data[i]
                if c == ord("*"):
                    any_byte = data[i + 1 : i + 2] == b"*"
                    loops.append((bit, any_byte))
                    i += 1 + any_byte
                    continue
                if c == ord("?"):
                    steps.append((bit, None))
                else:
                    if c == ord("\\") and i + 1 < len(data):
                        i += 1
                    steps.append((bit, data[i]))
                bit += 1
                i += 1
            self.last.append(bit)
            bit += 1
        words = max(1, -(-bit // 64))
        one = lambda b: (b // 64, np.uint64(1 << b % 64))
        self.move = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        for b, byte in steps:
            w, mask = one(b)
            if byte is None:
                self.move[[x for x in range(256) if x != SLASH], w] |= mask
            else:
                self.move[byte, w] |= mask
        for b, any_byte in loops:
            w, mask = one(b)
            self.stay[[x for x in range(256) if any_byte or x != SLASH], w] |= mask
        for b in self.first:
            w, mask = one(b)
            self.start[w] |= mask

    def match(self, texts: list[bytes]):
        """Boolean matrix (text, glob): the whole text matches the glob."""
        import numpy as np

        n = len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        state = np.repeat(self.start[None, :], n, axis=0)
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)[order] if n else sizes
        ends = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0)) + 1), side="left")
        for i in range(int(sizes.max(initial=0))):
            k = int(ends[i])  # the texts longer than i
            byte = data[begin[:k] + i]
            live = state[:k]
            moved = live & self.move[byte]
            live &= self.stay[byte]
            live |= moved << np.uint64(1)
            live[:, 1:] |= moved[:, :-1] >> np.uint64(63)
        out = np.zeros((n, len(self.last)), bool)
        for g, b in enumerate(self.last):
            out[order, g] = (state[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)
        return out


def plain(text: str) -> str:
    """The glob that matches exactly this text."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def canonical(url: str = "url"):
    """(host, path) columns of a URL column."""
    rest = F.expr(f"CASE WHEN locate('://', {url}) > 0 THEN substring({url}, locate('://', {url}) + 3) ELSE '' END")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge(pages: DataFrame, rules=None, block_globs=None) -> DataFrame:
    """Host, path, deciding rule and verdict of every URL."""
    rules = SITE_RULES if rules is None else rules
    block_globs = BLOCK_GLOBS if block_globs is None else block_globs
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))  # stable: earlier first among equals
    globs = [g + plain(h + p) + "**" for _, h, p in ranked for g in ("", "*.")] + list(block_globs)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        automaton = GlobSet(globs)
        names = [h + p for _, h, p in ranked] + [None]
        verdicts = np.array([v for v, _, _ in ranked] + ["allow", "block"])
        for batch in batches:
            hosts, paths = common.texts(batch.column("host")), common.texts(batch.column("path"))
            hit = automaton.match([(h + p).encode("utf-8", "replace") for h, p in zip(hosts, paths)])
            k = len(ranked)
            by_rule = hit[:, 0 : 2 * k : 2] | hit[:, 1 : 2 * k : 2]
            rule = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1), k) if k else np.zeros(len(hosts), int)
            blocked = hit[:, 2 * k :].any(axis=1)
            verdict = verdicts[np.where(rule < k, rule, k + blocked)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    pa.array(hosts, pa.string()),
                    pa.array(paths, pa.string()),
                    pa.array([names[i] for i in rule], pa.string()),
                    pa.array(verdict.tolist(), pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = canonical()
    return pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path")).mapInArrow(run, SCHEMA)
