"""Language of documents and of their passages (problem 10).

One interpolated Kneser-Ney character model per language. The n-grams of all languages lie in one sorted array of
64-bit hashes per order; beside each hash stand, language by language, its discounted probability and, for
contexts, the weight of the shorter order. A text is scored in whole, word by word: words are scored once per
Python worker with binary search over the hash arrays and then remembered. The language with the lowest cross-entropy
per character wins. It is rejected (null) where that cross-entropy is higher than held-out lines of the language have at
that length; the confidence is a posterior whose temperature is fitted, length by length, on held-out snippets, and is
never above the share of them that came out right.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import LANGUAGES, label_language

#: Order of the n-grams, and the words that one worker remembers before it starts anew.
ORDER, REMEMBER = 4, 300_000
#: Share of held-out lines that may come out as another language than theirs, and the lead in nats that is asked for
#: beyond what they show, for a line to be given to another language than its text's.
FALSE_LINES, MARGIN = 0.001, 20.0
#: A text is of none of the languages where its cross-entropy is beyond that of held-out lines (but for REJECTED of them)
#: and SLACK nats per character more, as other subjects use other words. An ideograph may well be new to the sample, at
#: about UNSEEN nats; letters of other scripts cost more.
REJECTED, SLACK, UNSEEN = 0.002, 2.4, 13.0
#: Characters up to which snippets are calibrated together, and the temperatures that are tried.
LENGTHS, TEMPERATURES = (6, 12, 24, 48, 96), (1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05)
#: Letters that such a line has at least (a heading of two or three words says too little), and signs without spaces.
LEAST_LETTERS, LEAST_SIGNS = 24, 8
#: A line in a script that its text's language does not use needs fewer.
OTHER_SCRIPT = 8
#: Bound of the training sample: rows per language, pieces of one row, and characters of one piece (a line or part of one).
SAMPLE_ROWS, SAMPLE_LINES, SAMPLE_CHARS = 150, 40, 400
#: Scripts of the languages that are not written in Latin letters (fixed values).
SCRIPT = {"ru": "cyrillic", "zh": "cjk", "ja": "cjk", "hi": "devanagari", "th": "thai", "ar": "arabic"}
SPAN = 1 << 40

#: Sentences that stand in for a language of which the sample has little or nothing.
SEED = {
    "en": "The man who was there said that it is not yet known whether they had been to the house. Which of these would you have done, and why? He believed her, but she did not answer. Of the pages he left behind, only a few mention the first one. It seemed that the others were asking about this. What should we do when there is nothing to be said?",
    "fr": "L'homme qui était là a dit que l'on ne sait pas encore s'ils sont allés à la maison. Pourquoi n'a-t-elle pas répondu à cette question ? Il ne faut pas que les autres soient avec nous dans la ville. Des pages qu'il a laissées, peu évoquent le premier. Elle croyait que c'était une bonne chose, mais il est parti sans rien dire.",
    "de": "Der Mann, der dort war, sagte, dass man noch nicht wisse, ob sie zu dem Haus gegangen sind. Warum hat sie auf diese Frage nicht geantwortet? Die anderen sollten nicht mit uns in der Stadt sein. Von den Seiten, die er hinterließ, nennen nur wenige das erste. Sie glaubte, es sei eine gute Sache, doch er ging fort, ohne etwas zu sagen.",
    "es": "El hombre que estaba allí dijo que todavía no se sabe si han ido a la casa. ¿Por qué no respondió ella a esta pregunta? Los otros no deben estar con nosotros en la ciudad. De las páginas que dejó, pocas mencionan el primero. Ella creía que era una buena cosa, pero él se marchó sin decir nada.",
    "pt": "O homem que estava ali disse que ainda não se sabe se eles foram à casa. Por que não respondeu ela a esta pergunta? Os outros não devem estar conosco na cidade. Das páginas que deixou, poucas mencionam o primeiro. Ela acreditava que era uma boa coisa, mas ele partiu sem dizer nada.",
    "it": "L'uomo che era lì disse che non si sa ancora se sono andati alla casa. Perché lei non rispose a questa domanda? Gli altri non devono essere con noi nella città. Delle pagine che ha lasciato, poche nominano il primo. Credeva che fosse una buona cosa, ma egli partì senza dire nulla.",
    "ru": "Человек, который был там, сказал, что ещё не известно, пошли ли они в дом. Почему она не ответила на этот вопрос? Другие не должны быть с нами в городе. Из страниц, которые он оставил, немногие упоминают первую. Она думала, что это хорошо, но он ушёл, ничего не сказав.",
    "zh": "那个人说，现在还不知道他们是不是去了那所房子。她为什么没有回答这个问题呢？其他人不应该和我们一起在城里。他留下的几页里，只有几处提到第一个。她以为这是一件好事，但是他什么也没说就走了。",
    "ja": "そこにいた男は、彼らがその家に行ったかどうかはまだわからないと言った。なぜ彼女はこの質問に答えなかったのか。ほかの人は私たちと町にいてはならない。彼が残したページのうち、最初のものに触れたものは少ない。",
    "hi": "जो आदमी वहाँ था उसने कहा कि अभी तक यह मालूम नहीं है कि वे घर गए थे या नहीं। उसने इस प्रश्न का उत्तर क्यों नहीं दिया? दूसरे लोग हमारे साथ शहर में नहीं होने चाहिए।",
    "th": "ชายที่อยู่ที่นั่นบอกว่ายังไม่รู้ว่าพวกเขาไปที่บ้านหรือไม่ ทำไมเธอจึงไม่ตอบคำถามนี้ คนอื่นไม่ควรอยู่กับเราในเมือง",
    "ar": "قال الرجل الذي كان هناك إنه لا يُعرف بعد هل ذهبوا إلى البيت. لماذا لم تجب عن هذا السؤال؟ لا ينبغي أن يكون الآخرون معنا في المدينة.",
}

#: A word: letters of an alphabet, one or two ideographs, a run of kana, or a few signs of a script without spaces.
WORD = re.compile(r"[぀-ヿ]{1,4}|[㐀-鿿]{1,2}|[฀-๿]{1,5}|(?:(?![぀-ヿ㐀-鿿฀-๿])[^\W\d_]|[ऀ-ॿ])+(?:['’](?![^\W\d_]*[A-Z])[^\W\d_]+)?")
NO_SPACES = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\u0e00-\u0e7f]{4}")
KANA, HAN = re.compile(r"[぀-ヺー-ヿ]"), re.compile(r"[㐀-鿿]")
BRACKETED = re.compile(r"[(（\[【][^)）\]】\n]*[)）\]】]")


WIDE = re.compile(r"[\uff10-\uff5a\uff66-\uff9f]")


def words_of(line: str) -> list[str]:
    if WIDE.search(line):
        line = unicodedata.normalize("NFKC", line)
    return WORD.findall(line.lower())


def _hashes(codes: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each position; positions before a word's start count as blanks."""
    h = np.full(len(codes), 0x9E3779B97F4A7C15 + n, dtype=np.uint64)
    at = np.arange(len(codes))
    with np.errstate(over="ignore"):
        for back in range(n - 1, -1, -1):
            i = at - back
            c = np.where(i >= start, codes[np.maximum(i, 0)], 32).astype(np.uint64)
            h = (h ^ (c + np.uint64(0x9E37))) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
    return h


def _layout(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, each closed by a blank; for each position its word's start; where the words begin."""
    text = " ".join(words) + " "
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    begin = np.cumsum(size) - size
    return codes, np.repeat(begin, size), begin


class Model:
    """Kneser-Ney models of several languages over joint sorted hash arrays."""

    def __init__(self, counts: dict[str, Counter]):
        """counts: of each language its words with their numbers."""
        self.languages = [x for x in LANGUAGES if x in counts]
        k = len(self.languages)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        grams: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]
        for lang in self.languages:
            words = list(counts[lang])
            codes, start, begin = _layout(words)
            weight = np.repeat(np.fromiter(counts[lang].values(), np.float64, len(words)), np.diff(np.append(begin, len(codes))))
            longer: np.ndarray | None = None
            for n in range(ORDER, 0, -1):
                h = _hashes(codes, start, n)
                ctx = _hashes(np.append(32, codes[:-1]), np.minimum(start + 1, np.arange(len(codes))), n - 1) if n > 1 else np.zeros(len(h), np.uint64)
                u, first, inv = np.unique(h, return_index=True, return_inverse=True)
                if n == ORDER:
                    c = np.bincount(inv, weight)
                else:  # continuation count: in how many longer n-grams it ends
                    _, pick = np.unique(longer, return_index=True)
                    c = np.bincount(inv[pick], minlength=len(u)).astype(np.float64)
                    c = np.maximum(c, 1e-9)
                longer = h
                grams[n - 1].append((u, ctx[first], c, np.array([])))
        for n in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([g[0] for g in grams[n - 1]]))
            ctxs = np.unique(np.concatenate([g[1] for g in grams[n - 1]]))
            a, b = np.zeros((len(keys), k), np.float32), np.ones((len(ctxs), k), np.float32)
            for j, (u, ctx, c, _) in enumerate(grams[n - 1]):
                once, twice = (c == 1).sum(), (c == 2).sum()
                d = min(0.9, max(0.3, once / (once + 2 * twice))) if once else 0.5
                cu, ci = np.unique(ctx, return_inverse=True)
                total = np.bincount(ci, c)
                kinds = np.bincount(ci)
                a[np.searchsorted(keys, u), j] = np.maximum(c - d, 0) / total[ci]
                b[np.searchsorted(ctxs, cu), j] = np.minimum(1, d * kinds / np.maximum(total, 1e-9))
            self.tables.append((keys, a))
            self.contexts.append((ctxs, b))
        self.ideographs = np.array([SCRIPT.get(x) == "cjk" for x in self.languages])
        # without held-out lines nothing is rejected, and a line needs the margin alone
        self.threshold = np.full(k, MARGIN)
        self.mean, self.spread, self.bound = np.zeros(k), np.zeros(k), np.full(k, np.inf)
        self.heat, self.cap = np.full(len(LENGTHS) + 1, 0.25), np.full(len(LENGTHS) + 1, 0.999)
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, k), np.float32)

    def __getstate__(self):
        return {**self.__dict__, "rows": {}, "scores": np.zeros((0, len(self.languages)), np.float32)}

    def _score(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's probability under each language."""
        codes, start, begin = _layout(words)
        p = np.full((len(codes), len(self.languages)), 1e-5, np.float32)
        before = np.append(32, codes[:-1])
        for n in range(1, ORDER + 1):
            h = _hashes(codes, start, n)
            ctx = _hashes(before, np.minimum(start + 1, np.arange(len(codes))), n - 1) if n > 1 else np.zeros(len(h), np.uint64)
            (keys, a), (ctxs, b) = self.tables[n - 1], self.contexts[n - 1]
            i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            j = np.minimum(np.searchsorted(ctxs, ctx), len(ctxs) - 1)
            p = np.where((keys[i] == h)[:, None], a[i], 0) + np.where((ctxs[j] == ctx)[:, None], b[j], 1) * p
        return np.add.reduceat(np.log(np.maximum(p, 1e-9)), begin, axis=0).astype(np.float32)

    def score_lines(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities (lines x languages) and the number of characters scored of each line."""
        cut = [words_of(x) for x in lines]
        if len(self.rows) > REMEMBER:
            self.rows, self.scores = {}, self.scores[:0]
        new = list({w for ws in cut for w in ws if w not in self.rows})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            base = len(self.rows)
            self.scores = np.concatenate([self.scores, self._score(part)])
            self.rows.update((w, base + i) for i, w in enumerate(part))
        rows = self.rows
        ids = np.fromiter((rows[w] for ws in cut for w in ws), np.int64)
        size = np.fromiter((len(ws) for ws in cut), np.int64, len(cut))
        chars = np.fromiter((sum(map(len, ws)) for ws in cut), np.int64, len(cut))
        out = np.zeros((len(lines), len(self.languages)), np.float64)
        full = size > 0
        if full.any():
            begin = (np.cumsum(size) - size)[full]
            out[full] = np.add.reduceat(self.scores[ids], begin, axis=0)
        return out, chars

    def restrain(self, lines: list[str], s: np.ndarray) -> np.ndarray:
        """Scores under the rule of scripts: ideographs without any kana are no Japanese, kana no Chinese."""
        if "ja" in self.languages and "zh" in self.languages:
            ja, zh = self.languages.index("ja"), self.languages.index("zh")
            for i, x in enumerate(lines):
                kana, han = len(KANA.findall(x)), len(HAN.findall(x))
                if han >= 8 and kana * 20 < han:
                    s[i, ja] -= 1e6
                elif kana * 8 > han:
                    s[i, zh] -= 1e6
        return s

    def scored(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities under the rule of scripts, and characters, of each line."""
        s, chars = self.score_lines(lines)
        return self.restrain(lines, s), chars

    def confidence(self, s: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Posterior of the best language of each row of scores, tempered by the row's length."""
        b = np.searchsorted(LENGTHS, chars)
        x = (s - s.max(1)[:, None]) * self.heat[b][:, None]
        return np.minimum(1 / np.exp(np.maximum(x, -700)).sum(1), self.cap[b])

    def rejected(self, lang: np.ndarray, s: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Whether the cross-entropy per character under each row's language is beyond what the language allows."""
        n = np.maximum(chars, 1)
        entropy = -s[np.arange(len(s)), lang] / n
        limit = self.mean[lang] + self.bound[lang] * self.spread[lang] / np.sqrt(n) + SLACK
        return entropy > np.where(self.ideographs[lang], np.maximum(limit, UNSEEN), limit)

    def best(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each line: index of the language, lead in nats over the next one, confidence, characters."""
        s, chars = self.scored(lines)
        top = s.argmax(1)
        rest = s.copy()
        rest[np.arange(len(s)), top] = -np.inf
        lead = s[np.arange(len(s)), top] - rest.max(1) if s.shape[1] > 1 else np.full(len(s), 99.0)
        return top, lead, self.confidence(s, chars), chars

    def calibrate(self, rows: list[tuple[str, str]]) -> None:
        """Sets thresholds, bounds and temperatures by held-out (language, line) rows, language by language."""
        rows = [r for r in rows if r[0] in self.languages]
        if not rows:
            return
        own = np.array([self.languages.index(r[0]) for r in rows])
        s, chars = self.scored([x for _, x in rows])
        at = np.arange(len(s))
        full = chars >= LEAST_LETTERS
        false_lead = s.max(1) - s[at, own]
        entropy = -s[at, own] / np.maximum(chars, 1)
        for j in range(len(self.languages)):
            on = full & (own == j)
            if on.sum() >= 20:
                self.threshold[j] = MARGIN + np.quantile(false_lead[on], 1 - FALSE_LINES)
                self.mean[j] = entropy[on].mean()
                dev = (entropy[on] - self.mean[j]) * np.sqrt(chars[on])
                self.spread[j] = max(1e-6, dev.std())
                self.bound[j] = max(3.0, np.quantile(dev, 1 - REJECTED) / self.spread[j])
        snippets: list[tuple[int, str]] = []
        for j, (_, line) in zip(own.tolist(), rows):
            words = words_of(line)
            for most in LENGTHS:
                size, i = 0, 0
                while i < len(words) and size + len(words[i]) <= most:
                    size += len(words[i])
                    i += 1
                if i:
                    snippets.append((j, " ".join(words[:i])))
            snippets.append((j, line))
        s, chars = self.scored([x for _, x in snippets])
        own = np.array([j for j, _ in snippets])
        b = np.searchsorted(LENGTHS, chars)
        for k in range(len(LENGTHS) + 1):
            on = (b == k) & (chars > 0)
            if on.sum() < 30:
                continue
            x, y = s[on] - s[on].max(1)[:, None], own[on]
            loss = [np.mean(np.log(np.exp(np.maximum(x * t, -700)).sum(1)) - np.maximum(x[np.arange(len(y)), y] * t, -50)) for t in TEMPERATURES]
            self.heat[k] = TEMPERATURES[int(np.argmin(loss))]
            self.cap[k] = ((x.argmax(1) == y).sum() + 1) / (len(y) + 2)


def _count(rows: list[tuple[str, str]]) -> dict[str, Counter]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, line in rows:
        counts[lang].update(words_of(line))
    return counts


def train(rows: list[tuple[str, str]], languages: tuple[str, ...] = LANGUAGES) -> Model:
    """Model of (language, line) rows. Labels may be wrong: lines that another language explains better are dropped
    first, each half being judged by a model of the other; then a tenth, held out, calibrates the model of the rest."""
    seed = [(k, v) for k, v in SEED.items() if k in languages]
    use = [(k, x) for k, t in rows if k in languages for x in t.splitlines() if len(x) > 15]
    for _ in range(2):  # so that no line speaks for its own label
        halves = [use[0::2], use[1::2]]
        kept = []
        for own, other in (halves, halves[::-1]):
            if own:
                judge = Model(_count(seed * 3 + other))
                top, lead, _, _ = judge.best([x for _, x in own])
                kept += [r for r, t, d in zip(own, top, lead) if judge.languages[t] == r[0] or d < 2]
        use = kept
    model = Model(_count(seed * 3 + [x for i, x in enumerate(use) if i % 10]))
    model.calibrate(use[::10])
    return model


def _pieces(key: str, text: str) -> list[str]:
    """Lines of a text, or parts of long ones, at most SAMPLE_LINES: those with the lowest hash."""
    import xxhash

    parts = [x[i : i + SAMPLE_CHARS] for x in text.splitlines() for i in range(0, len(x), SAMPLE_CHARS) if len(x) > 15]
    if len(parts) <= SAMPLE_LINES:
        return parts
    order = sorted(range(len(parts)), key=lambda i: xxhash.xxh64_intdigest(f"{key}:{i}"))
    return [parts[i] for i in sorted(order[:SAMPLE_LINES])]


def fit(df: DataFrame, text: str, label: str, key: str, languages: tuple[str, ...] = LANGUAGES, rows: int = SAMPLE_ROWS) -> Model:
    """Model fitted on a bounded sample of labelled rows: of each language the ``rows`` rows with the lowest hash of
    their key, and of each row the pieces with the lowest hash. Nulls and labels that name none of the languages are left
    out; an empty table gives the seed model. The first job reads the labels alone, the second the texts; the pieces are
    drawn on the executors, so that at most ``rows`` x SAMPLE_LINES x SAMPLE_CHARS characters a language come here."""
    lang, h = label_language(F.col(label)), F.pmod(F.xxhash64(key), F.lit(SPAN))
    named = df.select(lang.alias("lang"), h.alias("h"), F.col(key).cast("string").alias("k"), F.col(text).alias("text")).where(F.col("lang").isin(*languages))
    share = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # at most twelve rows
    out: list[tuple[str, str]] = []
    if share:
        limit = F.create_map(*[x for k, n in share.items() for x in (F.lit(k), F.lit(min(1.0, 1.3 * rows / n + 20 / n)))])
        part = named.where((F.col("h") < F.try_element_at(limit, F.col("lang")) * SPAN) & F.col("text").isNotNull())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lines = ["\n".join(_pieces(k or "", t)) for k, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lines, pa.string())], names=["lang", "h", "lines"])

        got = sorted((r["lang"], r["h"], r["lines"]) for r in part.mapInArrow(run, "lang string, h bigint, lines string").collect())
        seen: Counter = Counter()
        for lang_, _, t in got:
            seen[lang_] += 1
            if seen[lang_] <= rows:
                out.append((lang_, t))
    return train(out, languages)


def paragraphs_of(text: str) -> list[tuple[str, int]]:
    """The lines of a text that hold words, without markup and bracketed phrases, each with the number of its paragraph."""
    out, no = [], 0
    for x in text.splitlines():
        if not x.strip():
            no += 1
        elif y := BRACKETED.sub(" ", x).strip(" \t*#>-_|"):
            out.append((y, no))
    return out


def _sums(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, begin, axis=0)


def passage_languages(model: Model, texts: list[str | None]) -> list[list[tuple[str | None, float, int]]]:
    """Of each text its languages: (language, confidence, characters), the largest first.

    A line goes to another language than its text's where its lead over the text's is beyond the threshold of that
    language and it has letters enough (fewer, where the two are written in different scripts); lines of one paragraph
    that are not decided so are taken together. What a text has of a language is then scored together: it is rejected,
    with null for its language, where its cross-entropy is beyond that of held-out lines. Null, empty and wordless texts
    have no language.
    """
    lines, owner, para = [], [], []
    for i, t in enumerate(texts):
        for x, no in paragraphs_of(t or ""):
            lines.append(x)
            owner.append(i)
            para.append(no)
    out: list[list[tuple[str | None, float, int]]] = [[] for _ in texts]
    if not lines:
        return out
    s, chars = model.scored(lines)
    own = np.array(owner)
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    # a line's say in the language of the whole is bounded, so that none decides alone
    whole = _sums(np.maximum(s - s.max(1)[:, None], -60) * np.minimum(chars, 200)[:, None], begin)
    main = np.repeat(whole.argmax(1), np.diff(np.append(begin, len(own))))
    script = np.array([{"cyrillic": 1, "cjk": 2, "devanagari": 3, "thai": 4, "arabic": 5}.get(SCRIPT.get(x), 0) for x in model.languages])
    unspaced = np.fromiter((bool(NO_SPACES.search(x)) for x in lines), bool, len(lines))

    def solid(s: np.ndarray, chars: np.ndarray, unspaced: np.ndarray, main: np.ndarray) -> np.ndarray:
        at, top = np.arange(len(s)), s.argmax(1)
        least = np.where(unspaced, LEAST_SIGNS, np.where(script[top] != script[main], OTHER_SCRIPT, LEAST_LETTERS))
        return (s[at, top] - s[at, main] >= model.threshold[main]) & (chars >= least)

    sure = solid(s, chars, unspaced, main)
    lang = np.where(sure, s.argmax(1), main)
    # undecided lines that follow each other in one paragraph, as a wrapped one has them, together
    loose = np.flatnonzero(~sure & (s.argmax(1) != main))
    if len(loose):
        key = own[loose].astype(np.int64) * (max(para) + 1) + np.array(para)[loose]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (np.diff(loose) > 1)))
        ps, pc = _sums(s[loose], first), _sums(chars[loose], first)
        yes = solid(ps, pc, _sums(unspaced[loose].astype(int), first) > 0, main[loose[first]])
        lang[loose] = np.where(np.repeat(yes, np.diff(np.append(first, len(loose)))), np.repeat(ps.argmax(1), np.diff(np.append(first, len(loose)))), lang[loose])
    group = own * len(model.languages) + lang
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
    fits = s[np.arange(len(s)), lang] > -1e5  # but for short lines of another script
    gs, gc, judged = _sums((s * fits[:, None])[order], first), _sums(chars[order], first), _sums((chars * fits)[order], first)
    of, who = lang[order][first], own[order][first]
    # a language is judged by its own place among the others
    conf = model.confidence(gs, gc)
    conf = np.where(gs.argmax(1) == of, conf, np.minimum(conf, 1 - conf))
    off = model.rejected(of, gs, judged)
    for i, k, c, n, no in zip(who.tolist(), of.tolist(), conf.tolist(), gc.tolist(), off.tolist()):
        if n:
            out[i].append((None, 0.0, int(n)) if no else (model.languages[k], float(c), int(n)))
    for x in out:
        x.sort(key=lambda y: -y[2])
    return out


_WORKER: dict[int, Model] = {}


def worker_model(shared) -> Model:
    """The broadcast model, unpickled once per Python worker. Its size is bounded by the training sample."""
    if shared not in _WORKER:
        _WORKER.clear()
        _WORKER[shared] = pickle.loads(shared)
    return _WORKER[shared]


LANGUAGE_SCHEMA = "lang string, confidence double, chars bigint, passage_rank int"


def languages_of(df: DataFrame, model: Model, key: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """One row per text and language in it: key, kept columns, lang, confidence, chars, passage_rank (1 = main).

    Texts that are null or have no words give one row with null language; so does what a text has in no known
    language, with confidence 0. Other columns are dropped, so that their
    names cannot clash.
    """
    keep = keep or []
    blob = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = worker_model(blob.value)
        for b in batches:
            found = passage_languages(m, b.column(1 + len(keep)).to_pylist())
            rows = [(i, x, r + 1) for i, xs in enumerate(found) for r, x in enumerate(xs or [(None, None, 0)])]
            take = pa.array([i for i, _, _ in rows], pa.int64())
            cols = [b.column(j).take(take) for j in range(1 + len(keep))]
            cols += [pa.array([x[0] for _, x, _ in rows], pa.string()), pa.array([x[1] for _, x, _ in rows], pa.float64())]
            cols += [pa.array([x[2] for _, x, _ in rows], pa.int64()), pa.array([r for _, _, r in rows], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *keep, "lang", "confidence", "chars", "passage_rank"])

    source = df.select(key, *keep, F.col(text).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{types}, {LANGUAGE_SCHEMA}")


def unnamed_languages(found: DataFrame, key: str, label: Column) -> DataFrame:
    """Of the rows of :func:`languages_of`, those whose language the label does not name."""
    return found.where(F.col("lang").isNotNull() & ~F.coalesce(label_language(label) == F.col("lang"), F.lit(False))).select(key, "lang")
