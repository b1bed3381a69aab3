"""Page extraction on top of blocks and lines.

Lines of one page are handled as an array inside their row, so splitting and
trimming need no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscle.functions.bind import let
from corpuscle.functions.text import literal_pattern, strip, text_or_empty
from corpuscle.operators.ordered import first_rows
from corpuscle.rules.legal import one_of
from corpuscle.session import cut_lineage

# Words of question and answer pages.
READER = "Bạn đọc"
ASKING = ["giúp", "nhờ", "mong", "xin", "cho"]
ASKERS = ["tôi", "em", "mình", "con", "cháu", "luật sư", "ls"]
TITLES = ["luật sư", "ls", "th.s", "ths", "thạc sĩ", "ts", "tiến sĩ", "pgs", "gs", "chuyên gia",
          "giảng viên", "luật gia", "đại diện", "bhxh", "bảo hiểm xã hội", "bộ", "sở", "công an",
          "cơ quan", "phòng", "ban", "toà", "tòa", "cục", "chi cục", "trung tâm", "ubnd"]
SAYING = ["giải đáp", "trả lời", "cho biết", "cho hay", "phân tích", "nhận định", "giải thích",
          "trao đổi", "chia sẻ", "thông tin", "phản hồi", "tư vấn"]
OPENERS = ["giải đáp", "trả lời", "tư vấn", "phản hồi", "về vấn đề", "theo đó"]
INTROS = ["gửi câu hỏi", "gửi tới chuyên mục", "đặt câu hỏi", "có câu hỏi", "thắc mắc",
          "hỏi như sau", "nội dung câu hỏi"]
CAPTION_NOUNS = ["hình ảnh", "hình", "ảnh"]
CAPTION_SOURCES = ["từ internet", "minh họa", "minh hoạ", "minh hoa"]
GREETED = ["luat viet nam", "luatvietnam", "luật việt nam"]
OUTRO_MARKS = ["Trên đây là câu trả lời", "Trên đây là nội dung tư vấn", "BBT.Hệ Thống Pháp Luật",
               "BBT. Hệ Thống Pháp Luật", "Gửi câu hỏi cho luật sư"]
SEE_ALSO = ["Xem thêm"]
ANSWER_LABEL = r"(?U)^\s*Trả lời:\s*"
QUESTION_LABEL = r"(?U)^\s*Câu hỏi:\s*"
AUTHOR_LABEL = "Được tư vấn bởi"
NOISE_LINES = ["Đang theo dõi", "Đã biết"]
MINIMUM_ANSWER = 120

# ---------------------------------------------------------------- phrases

SAID_WITHIN = 80      # characters between a title and what it says
ASKED_WITHIN = 50     # characters between a reader and the question


def spoken(line: Column) -> Column:
    """Words of a line in lower case, one blank around each."""
    words = F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def _as_words(phrases: Sequence[str]) -> list[str]:
    return [f" {p.replace('.', ' ')} " for p in phrases]


def says(words: Column, phrases: Sequence[str]) -> Column:
    """Do the ``spoken`` words hold one of the phrases?"""
    return F.exists(F.array(*[F.lit(p) for p in _as_words(phrases)]), lambda p: F.contains(words, p))


def opens_answer(line: Column) -> Column:
    """A line that begins with an opener, or in which a title is soon followed by saying something."""
    def judged(words: Column) -> Column:
        begins = F.exists(F.array(*[F.lit(p) for p in _as_words(OPENERS)]), lambda p: F.startswith(words, p))
        speaks = F.exists(F.array(*[F.lit(t) for t in _as_words(TITLES)]), lambda t: F.contains(words, t) & says(
            F.substring(words, F.position(t, words) + F.length(t) - 1, F.lit(SAID_WITHIN + 14)), SAYING))
        return begins | speaks
    return let(spoken(line), judged)


def is_plea(line: Column) -> Column:
    return says(spoken(line), [f"{a} {who}" for a in ASKING for who in ASKERS])


def introduces_question(line: Column) -> Column:
    """A line that announces a question, or ends with a reader asking."""
    def judged(words: Column) -> Column:
        at = F.locate(f" {READER.lower()} ", words)
        asks = (at > 0) & F.endswith(words, F.lit(" hỏi ")) & (F.length(words) - at <= ASKED_WITHIN + len(READER) + 5)
        return says(words, INTROS) | asks
    return let(spoken(line), judged)


def is_reader(line: Column) -> Column:
    return F.startswith(spoken(line), F.lit(f" {READER.lower()} "))


def without_captions(text: Column) -> Column:
    """Brackets that hold nothing but an image noun and where it is from are left out."""
    words = [rf"{n}\s*{s}".replace(" ", r"\s*") for n in CAPTION_NOUNS for s in CAPTION_SOURCES]
    return F.regexp_replace(text, rf"(?iu)\s*\(\s*{one_of(words)}\s*\)", "")


def without_greeting(text: Column) -> Column:
    """A leading "xin hỏi" to one of the known addressees is left out, with the sign behind it."""
    names = [n.replace(" ", r"\s*") for n in GREETED]
    return F.regexp_replace(text, rf"(?iu)^\s*xin\s+hỏi\s+{one_of(names)}\s*[:,.!]?\s*", "")


def _test(rule) -> Callable[[Column], Column]:
    """A line test from a pattern or a function."""
    return rule if callable(rule) else lambda line: line.rlike(rule)


# ---------------------------------------------------------------- lines of a page


def first_index(lines: Column, test) -> Column:
    """0-based index of the first line that passes ``test(line, index)``, NULL when none."""
    return F.array_min(F.filter(F.transform(
        lines, lambda x, i: F.when(test(x, i), i)), lambda i: i.isNotNull()))


def join_lines(lines: Column) -> Column:
    return strip(F.array_join(lines, "\n"))


def is_byline(line: Column) -> Column:
    """Short line in capitals, or a line that is only a date and time."""
    capitals = (line == F.upper(line)) & (F.length(line) <= 40) & line.rlike(r"\p{Lu}")
    return capitals | line.rlike(r"(?U)^\d{1,2}/\d{1,2}/\d{4}[\s\d:]*$")


def trim_head(lines: Column, boilerplate) -> Column:
    """Drop leading lines while they match (a pattern or a test of a line)."""
    return let(lines, lambda v: let(
        F.coalesce(first_index(v, lambda x, _: ~_test(boilerplate)(x)), F.size(v)),
        lambda n: F.slice(v, n + 1, F.greatest(F.size(v) - n, F.lit(0)))))


def cut_tail(lines: Column, marks: Sequence[str]) -> Column:
    """Keep the lines before the first one that starts with a mark."""
    pattern = "^" + one_of([literal_pattern(m) for m in marks])
    return let(lines, lambda v: let(
        F.coalesce(first_index(v, lambda x, _: x.rlike(pattern)), F.size(v)),
        lambda n: F.slice(v, F.lit(1), n)))


def answer_lines(lines: Column, outro: Sequence[str] = tuple(OUTRO_MARKS),
                 skip: Sequence[str] = tuple(SEE_ALSO), label: str = ANSWER_LABEL) -> Column:
    """Answer body: tail cut, cross references dropped, label stripped, blank lines dropped."""
    see = "^" + one_of([literal_pattern(s) for s in skip])
    kept = F.filter(cut_tail(lines, outro), lambda x: ~x.rlike(see))
    return F.filter(F.transform(kept, lambda x: F.regexp_replace(x, label, "")),
                    lambda x: strip(x) != "")


def question_text(text: Column) -> Column:
    """Question without its label and greeting."""
    return without_greeting(F.regexp_replace(text, QUESTION_LABEL, ""))


def split_question(lines: Column, summary: Column, *, separator=is_reader,
                   answer_start=opens_answer, plea=is_plea,
                   separator_width: int = 120) -> Column:
    """Lines -> struct(question, answer); the three line tests are patterns or functions.

    A separator line with lines behind it wins; then the first line (not the
    very first) that opens an answer and is no plea; else all is answer.  An
    empty question falls back to the summary.
    """
    def halves(v: Column, cut: Column, resume: Column) -> Column:
        question = join_lines(F.slice(v, F.lit(1), cut))
        answer = join_lines(F.slice(v, resume + 1, F.greatest(F.size(v) - resume, F.lit(0))))
        return F.struct(F.when(question == "", summary).otherwise(question).alias("question"),
                        answer.alias("answer"))

    def choose(v: Column) -> Column:
        sep = first_index(v, lambda x, _: _test(separator)(x) & (F.length(x) < separator_width))
        ans = first_index(v, lambda x, i: (i >= 1) & _test(answer_start)(x) & ~_test(plea)(x))
        return let(F.struct(sep.alias("s"), ans.alias("a")), lambda at: (
            F.when(at["s"].isNotNull() & (at["s"] + 1 < F.size(v)),
                   halves(v, at["s"], at["s"] + 1))
            .when(at["a"].isNotNull(), halves(v, at["a"], at["a"]))
            .otherwise(F.struct(summary.alias("question"), join_lines(v).alias("answer")))))

    return let(lines, choose)


def with_content(rows: DataFrame, answer: str = "answer",
                 minimum: int = MINIMUM_ANSWER) -> DataFrame:
    """Answers under the minimum count as none; rows without an answer are dropped."""
    text = F.when(F.length(F.col(answer)) < minimum, "").otherwise(F.col(answer))
    return rows.withColumn(answer, text).where(F.col(answer) != "")


def tidy(text: Column, caption: str | None = None) -> Column:
    """Captions out, no space before punctuation, at most one empty line in a row."""
    t = F.regexp_replace(text, caption, "") if caption else without_captions(text)
    t = F.regexp_replace(t, r"[ \t]+([,.;:!?])", "$1")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def marker_slice(text: Column, starts: Sequence[tuple[str, int]], ends: Sequence[str], *,
                 gap: int = 50, default: int = 5000, required: Sequence[str] = ()) -> Column:
    """Part of a text from the first start pattern found to the nearest end mark behind it.

    ``starts`` are (pattern, characters to step back), in order; without an end
    mark ``default`` characters are taken.  NULL when nothing starts, or when
    none of the ``required`` words is in the part.
    """
    t = text_or_empty(text)
    begin = F.coalesce(*[
        F.when(F.regexp_instr(t, F.lit(p)) > 0,
               F.greatest(F.regexp_instr(t, F.lit(p)) - lead, F.lit(1))) for p, lead in starts])

    def part(s: Column) -> Column:
        stops = F.array(*[F.position(F.lit(e), t, s + gap) for e in ends])
        near = F.array_min(F.filter(stops, lambda p: p > 1))
        length = F.coalesce(near - s, F.lit(default))
        return strip(F.substring(t, s, length))

    body = F.when(begin.isNotNull(), let(F.coalesce(begin, F.lit(1)), part))
    if required:
        hit = F.lit(False)
        for word in required:
            hit = hit | F.contains(F.upper(body), F.lit(word))
        body = F.when(hit, body)
    return body


# ---------------------------------------------------------------- links

def unescape(text: Column) -> Column:
    """The entities that occur in addresses."""
    for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                         ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def listing(blocks: DataFrame, base: str, suffix: str, key: str = "page_id",
            dedupe: Sequence[str] = ("url",)) -> DataFrame:
    """Anchors as (key, url, title): absolute, of the right suffix, first of each url."""
    anchors = blocks.where((F.col("tag") == "a") & (F.col("href") != ""))
    url = F.when(F.startswith("href", F.lit("/")), F.concat(F.lit(base), "href")) \
        .otherwise(F.col("href"))
    rows = anchors.where(F.col("href").rlike(suffix)).select(
        key, "block_no", url.alias("url"), F.col("text").alias("title"))
    return first_rows(rows, list(dedupe), [key, "block_no"])


def author_lines(blocks: DataFrame, key: str = "page_id",
                 label: str = AUTHOR_LABEL) -> DataFrame:
    """First block per page that names the adviser, without the label."""
    rows = blocks.where((F.col("tag") != "a") & F.contains("text", F.lit(label)))
    first = rows.groupBy(key).agg(F.min_by("text", "block_no").alias("text"))
    return first.select(key, F.regexp_replace(
        "text", rf"(?U)^{literal_pattern(label)}:\s*", "").alias("author"))


def without_noise(lines: DataFrame, noise: Sequence[str] | DataFrame = tuple(NOISE_LINES)
                  ) -> DataFrame:
    """Text lines that are not in the noise set."""
    if isinstance(noise, DataFrame):
        return lines.join(noise.select("text").distinct(), "text", "left_anti") \
            .select(*lines.columns)
    return lines.where(~F.col("text").isin(*noise))


def attachments(pages: DataFrame, pattern: str, extension: str, preferred: Sequence[str],
                base: str = "", key: str = "page_id", html: str = "html") -> DataFrame:
    """Attachment per page: links by pattern, unescaped, the first of the best extension."""
    links = pages.select(key, F.posexplode(F.regexp_extract_all(
        html, F.lit(pattern), 1)).alias("pos", "link"))
    links = links.withColumn("url", F.concat(F.lit(base), unescape(F.col("link"))))
    ranks = [F.when(F.lower(F.regexp_extract("url", extension, 1)) == e, i)
             for i, e in enumerate(preferred)]
    ranked = links.withColumn("rank", F.coalesce(*ranks)).where(F.col("rank").isNotNull())
    return ranked.groupBy(key).agg(F.min_by("url", F.struct("rank", "pos")).alias("url"))


def numbered_attachments(pages: DataFrame, pattern: str, extension: str, wanted: str,
                         base: str = "", key: str = "page_id", html: str = "html") -> DataFrame:
    """All distinct attachments of one extension, numbered in page order."""
    links = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1),
                        lambda x: F.concat(F.lit(base), unescape(x)))
    fit = F.filter(F.array_distinct(links),
                   lambda u: F.lower(F.regexp_extract(u, extension, 1)) == wanted)
    return pages.select(key, F.posexplode(fit).alias("pos", "url")).select(
        key, (F.col("pos") + 1).alias("part"), "url")


def frontier(edges: DataFrame, seeds: DataFrame, keep: Column | None = None,
             cap: int = 0) -> DataFrame:
    """Breadth-first expansion over stored links: (node, depth), until nothing new is found.

    ``edges(src, dst)``, ``seeds(node)``.  ``keep`` filters the nodes worth
    following.  With a ``cap`` the work ends with the round that reaches that many
    nodes, and the first ones found are reported.  Each round is written out, so a
    lost executor repeats one round only; so are the distinct links, which every round reads.
    """
    links = cut_lineage(edges.select("src", "dst").distinct())
    seen = cut_lineage(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    last, depth = seen, 0
    while cap <= 0 or seen.count() < cap:
        depth += 1
        step = (last.join(links, last["node"] == links["src"])
                .select(F.col("dst").alias("node")).distinct())
        if keep is not None:
            step = step.where(keep)
        fresh = cut_lineage(step.join(seen.select("node"), "node", "left_anti")
                            .withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        seen = seen.unionByName(fresh)
        last = fresh
    return seen.orderBy("depth", "node").limit(cap) if cap > 0 else seen
