"""Secret scans, conversation repair and token alignment against plain brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stridelake.llm import alignment, conversation_repair, queries, secret_scan
from stridelake.llm.common import stored

SF = "/root/testdata/sf0.001"


# --- secrets ---


def github(rnd, prefix="ghp_"):
    body = "".join(rnd.choice(secret_scan.BASE62) for _ in range(30))
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        digits, n = secret_scan.BASE62[n % 62] + digits, n // 62
    return prefix + body + digits


def age(rnd):
    """A key with the checksum appended by the published encoder's rule: six zero digits, then the remainder."""
    name, data = "age-secret-key-", [rnd.randrange(32) for _ in range(52)]

    def polymod(values):
        c = 1
        for v in values:
            top, c = c >> 25, (c & 0x1FFFFFF) << 5 ^ v
            for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
                c ^= g if top >> i & 1 else 0
        return c

    full = [ord(x) >> 5 for x in name] + [0] + [ord(x) & 31 for x in name] + data
    rest = polymod(full + [0] * 6) ^ 1
    return (name + "1" + "".join(secret_scan.BECH32[d] for d in data + [rest >> 5 * (5 - i) & 31 for i in range(6)])).upper()


def brute_secrets(text):
    text, found = text or "", []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    for kind, pattern, holds in ((3, "gh[pousr]_[A-Za-z0-9]{36}", secret_scan.base62_crc), (4, "npm_[A-Za-z0-9]{36}", secret_scan.base62_crc),
                                 (5, "AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}", secret_scan.bech32)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if holds(m[0])]
    return [(secret_scan.KINDS[k], s, e) for s, k, e in sorted(found)]


def secret_texts():
    rnd = random.Random(3)
    bits = ["password", "PassWD", "ſecret", "secret", "toKen", "toKen", "api_key", "ApiKey", '"', "'", " ", "   ", ":", "=", "AKIA", "akia", "AKIA1234567890AB", "abcdefgh", "x" * 9,
            "deadbeef", "0123456789abcdef" * 2, "f" * 31, "F" * 40, "é", "\n", "ghp_", "npm_", "ß\U0001f600"]
    out = [None, "", " ", "f" * 32, "g" + "a" * 33 + "g", "a" * 7 + "é" + "b" * 40, "token " * 50, "password=" * 9 + "longenough", "=" * 99]
    out += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    good, other, key = github(rnd), github(rnd, "npm_"), age(rnd)
    out += [f"x {good} y", f"token={good}", good[:-1] + ("A" if good[-1] != "A" else "B"), other + "z", "é" + other, f"{key}", f"k: {key[:-1]}" + ("Q" if key[-1] != "Q" else "P"),
            key.lower(), github(rnd, "ghs_") + github(rnd, "gho_")]
    return out


def test_secrets_equal_a_plain_search(spark):
    rows = [(i, t, ["extra"], 1) for i, t in enumerate(secret_texts())]
    rows += [rows[20], (None, "password: none-of-it", None, None), (rows[9][0], "AKIA" + "7" * 12, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets array<string>, c0 int")
    got = collections.Counter((r["doc_id"], tuple(tuple(s) for s in r["secrets"])) for r in secret_scan.scan(docs).collect())
    assert got == collections.Counter((r[0], tuple(brute_secrets(r[1]))) for r in rows)
    kinds = {s[0] for _, found in got for s in found}
    assert kinds == set(secret_scan.KINDS)
    assert secret_scan.scan(docs.limit(0)).count() == 0
    assert secret_scan.scan(docs, carry=("doc_id", "c0", "secrets"), text="text").columns == ["doc_id", "c0", "secrets", "secrets"]


def test_a_wrong_checksum_hides_no_token_that_begins_inside_it(spark):
    rnd = random.Random(8)
    good = github(rnd)
    text = "ghp_" + "Z" * 33 + good  # the first candidate ends inside the good one's prefix
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(s) for s in secret_scan.scan(docs).collect()[0]["secrets"]] == [("github", 37, 37 + 40)]


def test_long_texts_are_scanned_in_linear_time(spark):
    import time

    keywords = secret_scan.automaton()
    start = time.perf_counter()
    for text in ("token " * 300_000, "password" + " " * 2_000_000 + "x", "a" * 2_000_000, "AKIA" * 400_000, "ghp_" + "a" * 1_000_000, "ab" * 500_000 + "z" + "é" * 9):
        secret_scan.spans(text, keywords)
    assert time.perf_counter() - start < 20


def test_secret_query_columns(spark):
    got = {r["doc_id"]: r for r in queries.op11_secret_scan(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        found = brute_secrets(r["text"])
        base = [s for s in found if s[0] in ("assign", "access", "hex")]
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        row = got[r["doc_id"]]
        assert [row[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        assert row["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert row["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e in found)


# --- conversation repair ---


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(" \t\n\x0b\f\r")[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Every sequence of edits with up to two insertions at a place, cheapest first, then least audit."""
    found, best = faults(rows), None

    def walk(i, initials, lines, audit, cost):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if not re.match(r"(s?(ua)*u?)?$", initials):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            way = (cost, audit, lines)
            best = way if best is None or way[:2] < best[:2] else best
        if not audit.endswith("II"):
            for role in ("user", "assistant"):
                walk(i, initials + role[0], [*lines, f"{role}:"], audit + "I", cost + 5)
        if i < len(rows):
            role, text = rows[i]
            walk(i + 1, initials, lines, audit + "D", cost + 2)
            if found[i] not in ("blank", "duplicate"):
                extra = 5 * (found[i] == "truncated")
                if role[:1]:
                    walk(i + 1, initials + role[:1], [*lines, f"{role}:{text}"], audit + "K", cost + extra)
                for new in ("user", "assistant"):
                    walk(i + 1, initials + new[0], [*lines, f"{new}:{text}"], audit + "R", cost + 1 + extra)

    walk(0, "", [], "", 0)
    return best, found


def brute_row(conv_id, rows):
    """``rows`` are (turn, role, text) in order."""
    (cost, audit, lines), found = brute_repair([(r, t) for _, r, t in rows])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (conv_id, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def in_order(rows):
    fixed = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(fixed, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(6)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", None, "", "ux"]
    texts = ["One.", "Two!", "Three?", "cut off", "", " \n\t", None, "End. \n", "é.", "One."]
    out = {}
    for conv in [*range(300), None]:
        n = rnd.randint(0, 6) if conv is not None else 4
        pick = roles if conv is None or conv % 3 else roles[:5]
        out[conv] = [(None if rnd.random() < 0.1 else rnd.randint(0, 7), rnd.choice(pick), rnd.choice(texts)) for _ in range(n)]
    return out


def test_repair_is_the_cheapest(spark, talks):
    rows = [(c, t, r, x, c is not None and c % 2 == 0, "extra") for c, all_ in talks.items() for t, r, x in all_]
    rows += [(c, 99, "user", "unseen.", None, "") for c in talks if c is None or c % 5 == 0]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, there boolean, audit string")
    present = ~F.col("text").eqNullSafe("unseen.")
    got = {tuple(r[c] for c in COLUMNS) for r in conversation_repair.repair(turns, present).collect()}
    want = {brute_row(c, in_order(all_)) for c, all_ in talks.items() if all_ or c is None or c % 5 == 0}
    assert got == want
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() and not any(r[1:7]) for r in got)
    assert conversation_repair.repair(turns.limit(0)).count() == 0


def test_repaired_rows_are_what_the_digest_is_of(spark, talks):
    rows = [(c, t, r, x) for c, all_ in talks.items() for t, r, x in all_]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    repairs = stored(conversation_repair.repair(turns), "repairs")
    lines = collections.defaultdict(list)
    for r in sorted(conversation_repair.repaired_turns(turns, repairs).collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in repairs.collect():
        assert hashlib.sha256("\n".join(lines[r["conv_id"]]).encode()).hexdigest() == r["repaired_sha256"]


def test_giant_conversation_spills_and_crosses_batches(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["user", "assistant"]), rnd.choice([f"t{i}.", f"t{i}.", f"cut {i}", "same."])) for i in range(3000)]
    now = conversation_repair.Conversation("1")
    for (turn, role, text), fault in zip(rows, faults([r[1:] for r in rows])):
        now.take(turn, role, text, {"": 0, "truncated": 1, "duplicate": 2, "blank": 3}[fault])
    whole = now.result()
    monkeypatch.setattr(conversation_repair, "SPILL_BYTES", 64)
    again = conversation_repair.Conversation("1")
    for (turn, role, text), fault in zip(rows, faults([r[1:] for r in rows])):
        again.take(turn, role, text, {"": 0, "truncated": 1, "duplicate": 2, "blank": 3}[fault])
    assert again.back.file is not None and again.result() == whole
    turns = spark.createDataFrame([(1, *r) for r in rows] + [(2, 0, "user", "Hi.")], "conv_id long, turn int, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = {r["conv_id"]: tuple(r[c] for c in COLUMNS[1:]) for r in conversation_repair.repair(turns).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[1] == whole[1:] and got[2][5:7] == (2, "D")


def brute_damage(conv, turn, role, text):
    harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if harm == 0:
        return []
    text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
    return [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)


def test_repair_query_over_damaged_conversations(spark):
    groups = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        groups[r["conv_id"]] += brute_damage(r["conv_id"], r["turn"], r["role"], r["text"])
    want = {brute_row(c, in_order(rows)) for c, rows in groups.items()}
    assert {tuple(r[c] for c in COLUMNS) for r in queries.op12_conversation_repair(spark, SF).collect()} == want


# --- alignment ---


class Brute:
    def __init__(self):
        self.both = alignment.Tokenizers(queries.BYTE_LEVEL, queries.PIECES)
        self.spelt = [s.to_pylist() for s in self.both.bytes]

    def document(self, text):
        want = (" " + (text or "")).encode()
        ids = [self.both.a.encode(" " + (text or ""), add_special_tokens=False).ids, self.both.b.encode(text or "")]
        if not text or any(b"".join(self.spelt[s][i] for i in own) != want for s, own in enumerate(ids)):
            return None
        ends = [list(itertools.accumulate(len(self.spelt[s][i]) for i in own)) for s, own in enumerate(ids)]
        common = sorted(set(ends[0]) & set(ends[1]))
        links = [(a, b) for a, x in zip(ids[0], ends[0]) for b, y in zip(ids[1], ends[1]) if x == y]
        groups = [[[i for i, e in zip(own, end) if low < e <= high] for own, end in zip(ids, ends)] for low, high in zip([0, *common], common)]
        return ids, links, ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups), len(common)


def brute_alignment(rows):
    brute = Brute()
    found = [(i, brute.document(t)) for i, t in rows]
    counts = collections.Counter(link for _, d in found if d for link in d[1])
    best = collections.defaultdict(int)
    for (a, b), n in counts.items():
        best[b] = max(best[b], n)
    out = collections.Counter()
    for i, d in found:
        if d is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            ids, links, shown, n = d
            out[i, len(ids[0]), len(ids[1]), n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest()] += 1
    return out


def scored(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, pairs string")
    aligned = stored(alignment.align(docs, queries.BYTE_LEVEL, queries.PIECES), "aligned")
    return collections.Counter(tuple(r) for r in alignment.scored(aligned).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def odd_texts():
    rnd = random.Random(7)
    out = [None, "", " ", "  two  blanks ", "\n\n\ttab", "the <|endoftext|> of <s>it</s> <unk>", "a▁b", "▁", "é ü ß 漢字かな 🙂🙃", "é Å ﬁ", "\x00 nul", "\x1c\x1d ctl", "x" * 4000, "don't we'll I'M",
           "<0x41> <0x0A>", " lead", "trail ", "12345 67.89", "\r\n   　x", "ab" * 50 + " " * 50 + "c"]
    words = ["the", "of", "Über", "que", "naïve", "çouelle", "1999", "...", "ab_cd", "\n", "\t", "  ", "🙂", "tokenization", "é"]
    return out + [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) for _ in range(120)]


def test_alignment_equals_brute_force(spark):
    rows = list(enumerate(odd_texts()))
    rows += [(5, rows[30][1]), (None, rows[31][1]), (30, rows[30][1])]
    want = brute_alignment(rows)
    assert scored(spark, rows) == want
    assert any(k[1] and k[3] != k[1] for k in want) and any(k[1] == 0 for k in want)
    assert scored(spark, [])  == collections.Counter()


def test_long_texts_are_aligned_as_if_whole(spark, monkeypatch):
    texts = odd_texts()
    long = [" ".join(t for t in texts[20:] if t) + " \n " + " ".join(t for t in texts[20:60] if t), " ".join(t for t in texts if t and "▁" not in t), "y" * 3000 + " z" * 900]
    both = alignment.Tokenizers(queries.BYTE_LEVEL, queries.PIECES)
    assert both.separable
    whole = alignment.Chunk(both, long)
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 500)
    for i, text in enumerate(long):
        assert len(both.pieces(text)) > 2 and " ".join(both.pieces(text)) == text
        cut = alignment._Long(both, text, True)
        assert cut.shown == whole.groups[i].as_py() and cut.counts.tolist() == whole.counts[i].tolist() and cut.good == whole.good[i]
        assert cut.digest == hashlib.sha256(cut.shown.encode()).hexdigest()
        own = whole.pairs.filter(alignment.pc.equal(whole.pairs["text"], i))
        assert sorted(zip(*cut.pairs.to_pydict().values())) == sorted(zip(*own.select(["a", "b", "n"]).to_pydict().values()))
    bad = alignment._Long(both, long[0] + " a▁b " + long[0], True)
    assert (bad.good, bad.counts.tolist(), bad.digest, bad.pairs) == (False, [0, 0, 0, 0], "", None)


def test_alignment_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = collections.Counter(tuple(r) for r in queries.op13_token_alignment(spark, SF).collect())
    assert got == brute_alignment(rows)


def test_groups_as_written(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in alignment.align(docs, queries.BYTE_LEVEL, queries.PIECES, groups=True).collect()}
    assert hashlib.sha256(rows[1]["groups"].encode()).hexdigest() == rows[1]["groups_sha256"] and rows[1]["groups"].count("|") == rows[1]["n_groups"]
    assert (rows[2]["groups"], rows[2]["groups_sha256"], rows[2]["pairs"]) == ("", "", [])
