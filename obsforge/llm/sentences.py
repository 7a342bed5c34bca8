"""Sentence boundaries across languages and scripts.

Every text is cut at paragraph breaks (an empty line) and, within a paragraph, at
candidate gaps.  Candidates are the ends of terminator runs (with the closing
quotes and brackets that follow) and, in scripts without spaces, white space.
Each candidate is judged from its surroundings alone.

* Spaced scripts, and end marks of all others (rules): abbreviations, initials,
  decimals, ellipses, what follows (lower case, digit, opening mark), and whether the
  mark lies inside a quotation or bracket that belongs to a larger sentence, with
  verbs of saying and particles after quotations for Chinese and Japanese.
* Thai, Han and Kana gaps without a mark: the words on both sides of the white space
  are found through a dictionary word lattice (least cost, unknown stretches
  allowed) and the gap is classified by final particles and by words that open or go
  on with a sentence.  Each unbroken stretch is segmented once.

The script is judged at each gap, not by the row's language code.

Defined cases: null, empty and blank texts have no sentences; offsets count code
points; a text without any end mark is one sentence; several rows with one text
get equal sentences; very long texts are processed whole, in linear time.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm import thai_words
from obsforge.llm.bpe import default_folder

# Abbreviations that never end a sentence.
ABBREVIATIONS = frozenset(
    """
    dr mr mrs ms prof st fig figs no nos vs approx p pp e.g i.e cf al ed vol ch sec eq dept gen col sgt capt rev hon
    ca vgl s abb nr bzw hr fr tab evtl ggf sog z bd hrsg inkl
    m mm mme mlle fig art p.ex ex env chap av boul cie
    sr sra srta dra dres ej p.ej aprox pág págs núm art ud uds
    т т.е ок ср с рис табл см проф им гл стр напр г ул тыс млн руб
    κ κα κος περ βλ σ σελ εικ αρ π.χ δηλ πχ αριθ
    डॉ पृ कि.ग्रा श्री प्रो सं कि चि क्र श्रीमती ई पू
    د أ أ.د ص ا رقم
    น กก ดร พ.ศ ค.ศ จ อ ต ถ รศ ผศ
    """.split()
)
# Abbreviations that may end a sentence, as what follows shows.
FINAL_ABBREVIATIONS = frozenset("etc a.m p.m usw u.a h т.д т.п др κ.ά κ.λπ κλπ μ.μ π.μ إلخ م ص.م jr sr inc ltd co u.s.w u.v.a kg km cm mm".split())
TERMINATORS = ".!?…。！？｡．؟۔।॥‼⁇⁈⁉"
WIDE = "。！？｡"
OPENERS, CLOSERS = "“„«「『（([【《〈‹﹁〔［", "”“»」』）)]】》〉›﹂〕］"
PAIRS = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "（": "）)", "(": ")）", "[": "]", "【": "】", "《": "》", "〈": "〉", "‹": "›", "〔": "〕", "［": "］", "»": "«"}
SURE_CLOSERS = "”」』）)]】》〉"
DASHES = "—–―-"
# German months, before which a day is an ordinal with a full stop.
MONTHS = r"(?:Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b"
# Thai words after a blank that go on with the sentence.
THAI_GOES_ON = frozenset("และ ที่ ของ แล้ว เช่น ๆ ใน เมื่อวานนี้ เมื่อวาน สำหรับ หรือ แต่ จึง ไว้ ฯลฯ ก็ ว่า ซึ่ง โดย เพื่อ กับ จาก ถึง ด้วย นั้น นี้".split())
# Thai words that begin with one of those and yet open a sentence.
THAI_OPENS = frozenset("ในการ ในขณะ แต่ละ ที่จริง ที่สุด จากนั้น".split())
# Thai words that need more on their right.
THAI_OPEN_END = frozenset("ว่า ที่ เวลา และ หรือ ของ ใน กับ จาก ถึง เพราะ ถ้า แต่ ประมาณ เพียง หมายเลข รูปที่ รุ่น แฟ้ม ต่าง คือ เป็น ด้วย โดย เพื่อ ซึ่ง".split())
# Thai words that open a subordinate clause, and those that show that its main clause is there.
THAI_SUBORDINATE = frozenset("ถ้า หาก เมื่อ เพราะ เนื่องจาก แม้ แม้ว่า ถ้าหาก ขณะที่ ก่อนที่ หลังจาก".split())
THAI_ANSWERS = ("จึง", "ก็", "แล้ว", "เลย")
# Thai particles that close a sentence.
THAI_FINAL = frozenset("ครับ ค่ะ คะ นะ ไหม เลย จ้ะ ล่ะ สิ เถอะ ฯลฯ เท่านั้น แหละ หรือยัง".split())
# The dictionary of the word lattice: a general one, and the function words above.
THAI_WORDS = thai_words.WORDS | {w for w in THAI_GOES_ON | THAI_OPENS | THAI_OPEN_END | THAI_SUBORDINATE | THAI_FINAL if len(w) > 1}
THAI_LONGEST = max(map(len, THAI_WORDS))
# Chinese and Japanese words that close a sentence, that open one, and that go on with one.
HAN_FINAL = frozenset("了 吗 嗎 呢 吧 啊 呀 啦 嘛 哦 喔 哟 着呢 而已 です ます でした ました ません ませんでした でしょう ましょう ください である だった だ よ ね わ ぞ かな かしら ですか ますか ですね ですよ ますね ますよ 下さい".split())
HAN_OPENS = frozenset(
    """
    我 你 您 他 她 它 我们 我們 你们 你們 他们 他們 她们 这 這 那 这个 這個 那个 这里 這裡 但是 但 不过 不過 然而 因此 所以 因为 因為 如果 虽然 雖然 另外 此外 同时 同時 首先 其次 最后 最後 然后 然後 今天 昨天 明天 现在 現在 请 請
    しかし そして また だから つまり ところが さて なお まず 次に では でも それから それで そこで ただし さらに 私 私たち 彼 彼女 これ それ あれ この その あの ここ そこ もし 今日 昨日 明日 今
    """.split()
)
HAN_GOES_ON = frozenset("的 地 得 和 与 與 或 及 跟 は が を に で と も の へ や から まで より って という ので のに けど けれど けれども し て".split())
# Chinese verbs of saying that may follow a quotation, and Japanese particles that go on after one.
ZH_SAYS = regex.compile(r"[^。！？\n]*?(?:问道|喊道|说道|叫道|答道|写道|问|说|喊|叫|道)(?:[，。：！？,]|\Z)")
JA_AFTER_QUOTE = "とはがをにのでもやへ、，"
# As far as an abbreviation can reach back, with a blank after each of its full stops: no longer word is one.
LOOK_BACK = 2 * max(map(len, ABBREVIATIONS | FINAL_ABBREVIATIONS)) + 2

BLANK = regex.compile(r"\s*")
THAI = regex.compile(r"\p{Thai}")
THAI_RUN = regex.compile(r"\p{Thai}+")
HAN_RUN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー々]+")
LONE = regex.compile(r"\s+\p{Thai}|\s*\Z")
BREAK = regex.compile(r"(?:\r\n|[\n\r \x85])[^\S\n\r  \x85]*(?:\r\n|[\n\r \x85])\s*| \s*")
TERM = regex.compile(rf"[{regex.escape(TERMINATORS)};\u037e](?:\s?[{regex.escape(TERMINATORS)}])*")
GAP = regex.compile(r"(?<=\S)\s+(?=\S)")
NO_LETTER = regex.compile(r"[\p{P}\p{S}\s]+")
IN_ADDRESS = regex.compile(r"[/_@]")
SPACES = regex.compile(r"\s+")
MARKED = regex.compile(rf"[{regex.escape(OPENERS + CLOSERS)}\"]")
MONTH = regex.compile(MONTHS)
WORD_BEFORE = regex.compile(r"[\p{L}\p{M}]+(?:\.[   ]?[\p{L}\p{M}]+)*$")
LATIN_BEFORE = regex.compile(r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{M}]+(?:\.[ \u00a0\u202f]?[\p{Latin}\p{Greek}\p{Cyrillic}\p{M}]+)*$")
ORDINAL = regex.compile(r"(?:^|[^\p{N}.,:])\d{1,2}$")
HAN_KANA = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー々]")
CASED = regex.compile(r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Armenian}]")
GREEK = regex.compile(r"\p{Greek}")
# Openers by the closers that close them.
OPENED_BY = {c: [o for o, cs in PAIRS.items() if c in cs] for c in {c for cs in PAIRS.values() for c in cs}}


def han_dictionary(folder: str | None = None, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> frozenset[str]:
    """The Han and Kana words of a public vocabulary for many languages, with the function words above."""
    found = {w for w in HAN_FINAL | HAN_OPENS | HAN_GOES_ON if len(w) > 1}
    with open(os.path.join(folder or default_folder(), vocabulary), "rb") as f:
        for line in f:
            try:
                w = base64.b64decode(line.split()[0]).decode().strip()
            except ValueError:
                continue
            if len(w) > 1 and HAN_RUN.fullmatch(w):
                found.add(w)
    return frozenset(found)


@lru_cache(4)
def _longest(dictionary: frozenset[str]) -> int:
    return max(map(len, dictionary), default=0)


@lru_cache(1)
def _han_words() -> frozenset[str]:
    return han_dictionary()


def words(chunk: str, dictionary: frozenset[str] = THAI_WORDS, longest: int = THAI_LONGEST) -> list[str]:
    """Least-cost path through the word lattice: a known word costs 1, an unknown character 1.5."""
    n = len(chunk)
    cost, back = [0.0] + [1e18] * n, [0] * (n + 1)
    for i in range(n):
        if cost[i] + 1.5 < cost[i + 1]:
            cost[i + 1], back[i + 1] = cost[i] + 1.5, i
        for j in range(i + 2, min(n, i + longest) + 1):
            if chunk[i:j] in dictionary and cost[i] + 1 <= cost[j]:
                cost[j], back[j] = cost[i] + 1, i
    out, i = [], n
    while i:
        out.append(chunk[back[i] : i])
        i = back[i]
    return out[::-1]


def pairs(text: str) -> tuple[list[tuple[int, int]], set[int]]:
    """(open, close) of each outermost quotation or bracket that is closed, in order; the places of all closing marks."""
    out, stack, held = [], [], Counter()
    for m in MARKED.finditer(text):
        c, i = m[0], m.start()
        if any(held[o] for o in OPENED_BY.get(c, ())) or c == '"' and stack and stack[-1][0] == '"':
            # What was opened after the partner stays unclosed; each mark leaves the stack once.
            while True:
                o, at = stack.pop()
                held[o] -= 1
                if c in PAIRS.get(o, "") or c == '"' == o:
                    break
            out.append((at, i))
        elif c in OPENERS or c == '"':
            stack.append((c, i))
            held[c] += 1
    out.sort()
    closes = {e for _, e in out}
    top, reach = [], -1
    for o, e in out:
        if o > reach:
            top.append((o, e))
            reach = e
    return top, closes


class Runs:
    """The maximal stretches of one kind of character, in order; their words once asked for."""

    def __init__(self, text: str, kind: regex.Pattern, dictionary: frozenset[str] = frozenset(), longest: int = 0):
        self.text, self.kind, self.dictionary, self.longest, self.kept = text, kind, dictionary, longest, {}

    @cached_property
    def begs(self) -> list[int]:
        return [m.start() for m in self.kind.finditer(self.text)]

    @cached_property
    def ends(self) -> list[int]:
        return [m.end() for m in self.kind.finditer(self.text)]

    def holding(self, i: int) -> int | None:
        """Number of the stretch that holds position ``i``."""
        k = bisect_right(self.begs, i) - 1
        return k if k >= 0 and i < self.ends[k] else None

    def last_before(self, i: int) -> int:
        """End of the last stretch that begins before ``i``, or −1."""
        k = bisect_left(self.begs, i) - 1
        return min(self.ends[k], i) if k >= 0 else -1

    def words(self, k: int) -> list[str]:
        if k not in self.kept:
            self.kept[k] = words(self.text[self.begs[k] : self.ends[k]], self.dictionary, self.longest)
        return self.kept[k]


class Paragraph:
    def __init__(self, text: str, beg: int, end: int, han: frozenset[str]):
        self.t, self.beg, self.end = text[beg:end], beg, end
        self.pairs, self.closes = pairs(self.t)
        self.opens = [p[0] for p in self.pairs]
        self.blunt = Runs(self.t, NO_LETTER)
        self.spaces, self.address = Runs(self.t, SPACES), Runs(self.t, IN_ADDRESS)
        self.thais = Runs(self.t, THAI_RUN, THAI_WORDS, THAI_LONGEST)
        self.hans = Runs(self.t, HAN_RUN, han, _longest(han))

    def around(self, i: int) -> tuple[int, int] | None:
        """The pair that has position ``i`` inside."""
        k = bisect_right(self.opens, i) - 1
        return self.pairs[k] if k >= 0 and self.pairs[k][0] < i <= self.pairs[k][1] else None

    def greek_before(self, i: int) -> bool:
        t = self.t
        i -= i > 0 and t[i - 1].isspace()
        while i > 0 and (t[i - 1] in "»”)" or unicodedata.category(t[i - 1])[0] == "M"):
            i -= 1
        return i > 0 and GREEK.match(t, i - 1) is not None

    def candidates(self) -> Iterator[tuple[int, int, str, int, int]]:
        """(end of what belongs to the sentence on the left, begin of the next, kind, mark's begin, mark's end)."""
        found, t = {}, self.t
        for m in TERM.finditer(t):
            e = m.end()
            if m[0][0] in ";\u037e" and not (m[0] == "\u037e" or self.greek_before(m.start())):
                continue
            if e < len(t) and unicodedata.category(t[e]) in ("Mn", "Cf"):
                e += 1
            last = e
            while (j := last + (last + 1 < len(t) and t[last].isspace() and t[last + 1] in "»”")) < len(t) and (j in self.closes or t[j] in SURE_CLOSERS):
                last = j + 1
            if last > e:
                e = last
                if e < len(t) and t[e] in TERMINATORS:
                    continue
            nxt = BLANK.match(t, e).end()
            if nxt < len(t):
                found[nxt] = (e, nxt, "mark", m.start(), m.end())
        thai = THAI.search(t) is not None
        if thai or HAN_KANA.search(t):
            for m in GAP.finditer(t):
                han = HAN_RUN.match(t, m.end()) is not None and HAN_KANA.match(t, m.start() - 1) is not None
                if han or thai:
                    found.setdefault(m.end(), (m.start(), m.end(), "han" if han else "thai", m.start(), m.start()))
        for k in sorted(found):
            yield found[k]

    def spans(self) -> Iterator[tuple[int, int]]:
        start = BLANK.match(self.t).end()
        for e, nxt, kind, mark, mark_end in self.candidates():
            if e <= start:
                continue
            if kind == "mark":
                ends = self.mark(start, e, nxt, mark, mark_end)
            else:
                ends = self.thai(start, e, nxt) if kind == "thai" else self.han(e, nxt)
            if ends:
                yield start, e
                start = nxt
        yield start, len(self.t)

    def mark(self, start: int, e: int, nxt: int, mark: int, mark_end: int) -> bool:
        t = self.t
        run, spaced = t[mark:mark_end].replace(" ", ""), nxt > e
        first = t[nxt]
        inside = self.around(mark)
        if inside and inside[1] >= e:
            return False  # the quotation or bracket goes on
        closed = inside is not None
        over = self.blunt.holding(nxt)
        head = t[min(len(t) - 1, nxt if over is None else self.blunt.ends[over])]
        lower = unicodedata.category(head) == "Ll" or first in ",;:،；，、"
        ellipsis = "…" in run or len(run) >= 3 and set(run) == {"."}
        if closed:
            if first in DASHES + ",;:،，、؛;)" or lower:
                return False
            opened = inside[0]
            if t[opened] in "（([【〔［":
                return opened <= start  # a bracketed sentence ends with its bracket, an inserted one does not
            if HAN_KANA.match(first) or t[opened] in "「『":
                if first in JA_AFTER_QUOTE and t[opened] in "「『":
                    return False
                return opened > start or not ZH_SAYS.match(t, nxt)
            if THAI.match(first):
                return self.thai(start, e, nxt)
            if not CASED.match(head) and not head.isdigit():
                return opened > start  # without case: a leading quotation is followed by who said it
            return True
        if ellipsis:
            return spaced and bool(CASED.match(head)) and not lower and not (mark > 0 and t[mark - 1].isspace())
        if run[0] in WIDE or run[0] in "।॥؟۔":
            return True
        if "!" in run or "?" in run or "！" in run or "？" in run or run[0] in ";\u037e":
            if run[0] == "!" and not spaced and not (CASED.match(head) and not lower):
                return not first.isalnum() or HAN_KANA.match(first) is not None or THAI.match(first) is not None
            return not lower
        # A full stop.
        left = t[max(start, mark - LOOK_BACK) : mark]
        word = (LATIN_BEFORE if CASED.search(left[-1:]) else WORD_BEFORE).search(left)
        name = unicodedata.normalize("NFC", regex.sub(r"\s", "", word[0])).lower() if word else ""
        last = name.rsplit(".", 1)[-1]
        if first.isdigit() and not spaced and (not word or len(last) < 3 or not last.isalpha()):
            return False
        if not spaced:
            address = self.address.last_before(mark) > max(start, self.spaces.last_before(mark))
            if lower or not (first.isupper() or first in OPENERS + "¿¡" or first.isdigit() or not CASED.match(first) and first.isalpha()) or address and not first.isupper():
                return False
        if lower or not spaced and left[-1:].isdigit() and HAN_KANA.match(first):
            return False
        if ORDINAL.search(left) and MONTH.match(t, nxt):
            return False
        if name in FINAL_ABBREVIATIONS or _tail(name) in FINAL_ABBREVIATIONS:
            return True
        if name in ABBREVIATIONS or last in ABBREVIATIONS:
            return False
        if word and len(last) == 1 and not HAN_KANA.match(last) and last.isalpha() and word[0][-1].isupper():
            return False  # an initial
        return True

    def thai(self, start: int, e: int, nxt: int) -> bool:
        t, runs = self.t, self.thais
        if (p := self.around(e)) and p[1] >= e:
            return False
        stop = t[e - 1] == "." and runs.holding(e - 2) is not None if e > 1 else False
        a, b = runs.holding(e - 2 if stop else e - 1), runs.holding(nxt)
        closed = t[e - 1] in CLOSERS + '"'
        opening = t[nxt] in OPENERS
        if b is None:
            return closed and opening if a is None else opening and runs.words(a)[-1] in THAI_FINAL
        chunk, head = t[nxt : runs.ends[b]], runs.words(b)[0]
        opens = any(chunk.startswith(w) for w in THAI_OPENS)
        if not opens and (head in THAI_GOES_ON or any(chunk.startswith(w) and len(w) > 2 for w in ("และ", "แล้ว", "ไว้", "เช่น"))):
            return False
        if closed:
            return True
        if a is None:
            return False  # a number, a name in other letters, or a mark stands before
        if stop:
            return False
        if len(chunk) == len(head) and head in THAI_WORDS and head not in THAI_FINAL and LONE.match(t, runs.ends[b]):
            return False  # a lone word between blanks is a member of a list, no clause
        if runs.begs[a] <= start and any(t.startswith(w, start) for w in THAI_SUBORDINATE) and not any(w in runs.words(a) for w in THAI_ANSWERS):
            return False  # a subordinate clause that still waits for its main clause
        return runs.words(a)[-1] not in THAI_OPEN_END

    def han(self, e: int, nxt: int) -> bool:
        """White space between Han or Kana ends a sentence that is closed by a particle or copula, if what follows opens one or is no mere ending."""
        if (p := self.around(e)) and p[1] >= e:
            return False
        left, right = self.hans.words(self.hans.holding(e - 1)), self.hans.words(self.hans.holding(nxt))
        if right[0] in HAN_GOES_ON or left[-1] not in HAN_FINAL:
            return False
        return right[0] in HAN_OPENS or len(left[-1]) > 1


def _tail(name: str) -> str:
    return ".".join(name.split(".")[-2:])


def sentences(text: str | None, han: frozenset[str] | None = None) -> list[tuple[int, int]]:
    """(begin, end) offsets in code points of the sentences of one text."""
    if not text or text.isspace():
        return []
    out, at = [], 0
    han = _han_words() if han is None else han
    for m in [*BREAK.finditer(text), None]:
        end = m.start() if m else len(text)
        if text[at:end].strip():
            p = Paragraph(text, at, end, han)
            for b, e in p.spans():
                part = p.t[b:e]
                lead = len(part) - len(part.lstrip())
                body = part.strip()
                if body:
                    out.append((at + b + lead, at + b + lead + len(body)))
        at = m.end() if m else at
    return out


def sentence_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """(doc_id, sent_no, beg_char, end_char): one row a sentence; equal documents come out once.

    The word list (about 700 words) is read where the query is built, from ``folder``.
    """
    han = han_dictionary(folder)

    @F.pandas_udf("array<struct<beg_char:int,end_char:int>>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"beg_char": b, "end_char": e} for b, e in sentences(t, han)])

    cuts = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(cut(F.col(text_col))).alias("n", "s"))
    return cuts.select("doc_id", (F.col("n") + 1).cast("int").alias("sent_no"), "s.beg_char", "s.end_char").distinct()
