"""HTML extraction by two-pass block rules.

The first pass cuts a page into blocks and decides each by link density, container, length and stop-word density: good,
bad, or left open. In the second pass open short blocks inherit the label of their nearest decided neighbours (good if
either side is good and none is nearer and bad); blocks inside an article element are open at worst, and good where
nothing decided stands around them inside that article.

Defined cases: a null or empty page gives the empty text; a page cut short anywhere is read as far as it goes; blocks
without text vanish; page order is kept; pages of any length are read whole; repeated rows are rows of their own; columns kept go under other names
meanwhile, so theirs cannot clash; on a page whose longer blocks match no list of stop words, length and link density
decide.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits

# Frequent function words: those of English, French, Spanish and German together, then one list for each other language.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his i if in is it its not of on or she so that the their
    they this to was we were which will with you
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour que qui
    sa se ses son sont sur un une vous
    al como con de del el ella en es esta este la las lo los más no para pero por que se sin su sus un una y
    aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist
    mit nach nicht noch oder sich sie sind so um und uns von vor war wie wir zu zum zur""".split()
)
OTHER_STOP_WORDS = tuple(
    frozenset(x.split())
    for x in (
        "a al alla anche che chi ci come con da dal dalla de dei del della delle di e è era gli ha hanno i il in io la le lo ma mi nel nella non o per però più quando questa questo se si sono su sua sul sulla suo tra un una uno",
        "a ao aos as até com como da das de do dos e é ela ele em entre era essa esse esta este eu foi há isso já lhe mais mas na nas no nos não o os ou para pela pelo por que quem se sem ser seu são sua também um uma à às",
        "aan als bij dan dat de der deze die dit door een en er had heb heeft het hij hoe ik in is je kan maar me meer met mijn naar niet nog nu of om omdat ook op over te toen tot uit van veel voor was wat we werd wel wie wij ze zich zijn zo",
        "alla att av de den denna det dem där efter eller en ett från för ha hade han har hon i inte jag kan man med men mot mycket när och om på samma sig sin ska som så till under upp ut var vi vid är",
        "ad af at blev da de den der deres det dette du efter eller en er et for fra får ham han har havde hun hvad hvor i ikke ja jeg kan man med meget men mere mod når og også om op over på sig sin skal som til ud var ved vi vil være å ble etter ikkje seg skulle hva noe opp ut vært",
        "a aby ale bardzo był była było by być co czy dla do gdy go i ich jak jako jego jej jest jeszcze już kiedy która które który ma może na nie niż o od on ona oraz po pod przez przy się są ta tak tego tej ten to tylko tym w we z za ze że",
        "a aby ale ani až bez by byl byla bylo být co do i jak jako je jeho její jen jeho jsem jsou k kde když která které který má mezi na nebo není o od po pod podle pro před při s se si so sú tak také ten to tento tím u už v ve však z za ze že aj alebo bol bola bolo ako pri sa som",
        "a az azt be csak de egy el és ez ezt fel hogy is ha ki le lehet már még meg mert mi mint nagyon nem nincs olyan őt s sem után úgy vagy van vele volt",
        "a ai al ale au ca că care ce cel cu cum da de din după ea ei el era este fi fost iar în între la le lui mai nu o pe pentru prin sa să sau se și sunt sub un una unei unui",
        "ama bir bu ben biz çok da daha de değil diye en gibi göre hem her için ile ise kadar ki mi mı ne o olan olarak oldu onun sonra şu ve veya ya",
        "ei eli en että hän he ja joka jos jo kuin kun mutta myös ne niin nyt oli on olla ovat se sen sekä siitä tai tämä vain voi",
        "ada adalah akan atau bagi bahwa dalam dan dari dengan di dia ia ini itu juga karena ke kepada lebih mereka oleh pada saya sebagai sudah tidak untuk yang",
        "ai bị các cho có của đã đang đến để được hay khi không là làm lại mà một này những như nhưng người ở ra sẽ tại thì trong từ và vào về với",
        "а без бы был была были было быть в вам вас во вот все всё вы где да для до его ее её если есть еще ещё же за и из или им их к как когда ко которые который кто ли меня мне мы на над не него нее нет но о об он она они от по под при с со так также там то только том ты у уже чем что чтобы это этот я",
        "а або але без був була були було в вже ви від він вона вони все для до з за зі і із його її їх й коли ми на над не ні о про по при та так також те ти то у це що щоб як який які є",
        "без бил била били в във да до е за и из или има как като които който ли на не но ние от по при са се си след със с също така той това тя че ще а али били био је као који која које на од он она они се су то у што",
        "αλλά αν από αυτά αυτή αυτό για δεν είναι εκ ένα ένας ή η ήταν θα και κατά με μας μετά μια μιας μου να ο οι όπως όταν ότι που προς σε στα στη στην στις στο στον στους τα τη την της τις το τον του τους των ως",
        "أن أو إلى التي الذي إن بعد بين عن على في قد قبل كان كانت كل كما لا لم لن ما مع من هذا هذه هو هي و ذلك عند حتى",
        "از است این آن با بر برای به بود تا در را شد که ما من نیز و هم هر یا یک شده می خود",
        "אבל או אל אם אני את גם הוא היא היה הם זה זאת יש כי כל כמו לא לו מה מן עד על עם רק של",
        "और एक इस उस का कि की के को था थी थे द्वारा नहीं ने पर भी में यह वह से है हैं हो तो जो ही",
        "그 그는 그리고 것은 것이 또는 때 및 수 에 위해 은 을 이 있는 있다 한 할 하는 그러나",
    )
)
# Elements by their part in a page.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SKIPPED = frozenset("script style noscript template textarea select option button iframe object svg canvas head title input label math".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
# Elements that a start tag closes where they are open above the last of the others, as HTML has it.
_ROWS, _SPECIAL = ("table", "template", "html"), tuple(sorted((BLOCKS | {"button", "object", "select", "template"}) - {"address", "br", "dd", "div", "dt", "hr", "li", "p"}))
CLOSES = {
    "li": (("li",), _SPECIAL),
    "dt": (("dt", "dd"), _SPECIAL),
    "dd": (("dt", "dd"), _SPECIAL),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), _ROWS),
    "th": (("td", "th"), _ROWS),
    "tr": (("td", "th", "tr"), _ROWS),
    "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), _ROWS),
}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
ENDS_P = BLOCKS - frozenset("body br caption head html tbody td tfoot th thead tr".split())
_AROUND_P = ("table", "td", "th", "caption", "button", "object", "template", "html")
MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disclaimer|footer|header|legal|login|masthead|menu|modal|nav(?:bar|igation)?|newsletter|notice|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
#: Characters below which a block is short and from which it is long; stop-word shares; the share of characters in links.
SHORT, LONG, LOW, HIGH, LINKS = 70, 200, 0.12, 0.25, 0.33
GOOD, BAD, OPEN = 1, -1, 0

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|[^<]+|<", re.S)
_MARKED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# marks that write vowels (Devanagari, Thai, Arabic) belong to their words
_WORD = re.compile(r"(?:[^\W\d_]|[\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0900-\u0903\u093a-\u094f\u0e31-\u0e4e])+")
_SPACE = re.compile(r"\s+")
_PART_TAG = re.compile(r"<[a-zA-Z/!][^>]*\Z")


class _Block:
    __slots__ = ("boiler", "inside", "linked", "parts")

    def __init__(self, inside: bool, boiler: bool):
        self.parts, self.linked, self.inside, self.boiler = [], 0, inside, boiler


def blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    """(text, link density, inside an article, inside a boilerplate container) of each block with text."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, skipped, inside article, boilerplate
    skipped = inside = boiler = False
    places: dict[str, list[int]] = {}  # of each element's open ones on the stack
    links = 0
    now = _Block(False, False)

    def close(i: int) -> None:
        while len(stack) > i:
            places[stack.pop()[0]].pop()

    def close_implied(names: tuple[str, ...], around: tuple[str, ...]) -> None:
        if any(places.get(x) for x in names):
            floor = max((places[x][-1] for x in around if places.get(x)), default=-1)
            inner = [i for x in names for i in places.get(x, ())[-1:] if i > floor]
            while inner:
                close(min(inner))
                inner = [i for x in names for i in places.get(x, ())[-1:] if i > floor]

    at, n, match = 0, len(page), _TOKEN.match
    while at < n:
        m = match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            piece = m[0]
            if skipped or piece[:2] in ("<!", "<?"):
                continue
            now.parts.append(piece)
            if links:
                now.linked += len(piece.strip())
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCKS:
                out.append(now)
                now = None
            # one of a phrase, as </b>, never closes the article it stands in
            if places.get(name) and (name in BLOCKS or name in SKIPPED or all(places[x][-1] < places[name][-1] for x in ("article", "main") if places.get(x))):
                close(places[name][-1])
            skipped, inside, boiler = stack[-1][1:] if stack else (False, False, False)
            now = now or _Block(inside, boiler)
            continue
        if name == "a":
            links += 1
        if name in RAW:
            end = re.compile(f"</{name}\\s*>|\\Z", re.I).search(page, at)
            at = end.end()
            continue
        if name in ENDS_P:
            close_implied(("p",), _AROUND_P)
        if name in CLOSES:
            close_implied(*CLOSES[name])
        if name in BLOCKS or name in CLOSES:
            skipped, inside, boiler = stack[-1][1:] if stack else (False, False, False)
        if name in BLOCKS:
            out.append(now)
            links = links if name == "br" else 0
        if name not in VOID and not m[3].endswith("/"):
            marks = " ".join(x for y in _MARKED.findall(m[3]) for x in y)
            main = name in ("article", "main") or "articlebody" in m[3].lower()
            bad = name in BOILERPLATE and not (name == "header" and inside) or bool(marks and name != "body" and MARKS.search(marks))
            skipped, boiler, inside = skipped or name in SKIPPED, boiler or bad, inside or main
            places.setdefault(name, []).append(len(stack))
            stack.append((name, skipped, inside, boiler))
        if name in BLOCKS:
            now = _Block(inside, boiler)
    out.append(now)
    made = []
    for b in out:
        text = _SPACE.sub(" ", html.unescape("".join(b.parts))).strip()
        if text:
            made.append((text, min(1.0, b.linked / len(text)), b.inside, b.boiler))
    return made


def classify(page_blocks: list[tuple[str, float, bool, bool]]) -> list[bool]:
    """Which blocks are main text."""
    labels, shares, stops, counted, matched = [], [], 0, 0, False
    for text, linked, _, boiler in page_blocks:
        words = _WORD.findall(text.lower())
        stop = sum(w in STOP_WORDS for w in words)
        if stop < HIGH * len(words):
            stop = max(stop, *(sum(w in x for w in words) for x in OTHER_STOP_WORDS))
        shares.append(stop / max(1, len(words)))
        if not boiler and linked <= LINKS and len(text) >= SHORT:
            stops, counted, matched = stops + stop, counted + len(words), matched or shares[-1] >= HIGH
    unknown = not matched and stops < LOW * counted
    for (text, linked, inside, boiler), stop in zip(page_blocks, shares, strict=True):
        if boiler or linked > LINKS or text[0] == "©":
            label = BAD
        elif unknown and len(text) >= SHORT:  # no list matches: length and link density decide
            label = GOOD
        elif inside:
            label = GOOD if len(text) >= SHORT and stop >= LOW else OPEN
        elif len(text) < SHORT:
            label = OPEN
        elif stop >= HIGH or len(text) >= LONG and stop >= LOW:
            label = GOOD
        else:
            label = BAD if stop < LOW else OPEN
        labels.append(label)
    n = len(labels)

    def near(order):
        """The label and distance of the nearest decided block on one side; an article's blocks look only inside it."""
        out, last, kept = [(OPEN, n)] * n, (OPEN, -n), (OPEN, -n)
        for step, i in enumerate(order):
            seen = kept if page_blocks[i][2] else last
            out[i] = (seen[0], step - seen[1])
            if labels[i] != OPEN:
                last = (labels[i], step)
                kept = last if page_blocks[i][2] and not page_blocks[i][3] and labels[i] == GOOD else kept
        return out

    before, after = near(range(n)), near(range(n - 1, -1, -1))
    out = []
    for i, label in enumerate(labels):
        if label == OPEN:
            sides = [x for x in (before[i], after[i]) if x[0] != OPEN]
            if page_blocks[i][2]:
                label = GOOD if not sides else max(sides)[0]
            else:
                label = min(sides, key=lambda x: (x[1], -x[0]))[0] if sides else BAD
        out.append(label == GOOD)
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(_PART_TAG.sub("", page))
    return "\n".join(b[0] for b, good in zip(found, classify(found), strict=True) if good)


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """keep, text and n_chars of each page."""
    arrow_limits(pages.sparkSession)
    src = pages.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(html_col).alias("h"))
    schema = src.drop("h").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    for f in schema.fields:
        f.nullable = True

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.fieldNames())

    return src.mapInArrow(run, schema).toDF(*keep, *schema.fieldNames()[len(keep) :])
