"""Personal data in texts, in DataFrame functions only.

For each kind a regular expression proposes spans, a validator confirms them
(ranges of address parts, numbers of digits, Luhn, mod-97), and words shortly
before a span raise its score. Base kinds (email, ip, card, phone) stay when
they are confirmed, whatever their score; an added kind (iban, ssn, local
phone) stays if its score reaches ``THRESHOLD``.

Positions come from the pieces between the matches: a match starts where the
pieces and matches before it end. They, and what overlaps what, are found by
running once over the matches (:mod:`regstar.llm.scans`), so a text of very many
matches takes time in proportion to them. Offsets count code points; ends are
exclusive. Every regular expression runs in time linear in the text: runs are
matched possessively, and a match starts where a run starts (or where the last
match ended), never inside a run that was tried already.

Defined cases: a null text has no spans, and stays null in ``redact``; an
empty table gives no rows; repeated rows are treated alike; an added span that
overlaps a base span is dropped, unless it is an IBAN; ``redact`` joins
overlapping spans under the name of the first; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.llm.scans import cutter, scan

CONTEXT = 40  # code points before a span in which a context word counts
THRESHOLD = 0.5
SPAN = "struct<start:int,kind_order:int,end:int,kind:string,score:double>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    maybe: str  # a text without a match of this has none of ``pattern``
    score: float  # of a confirmed span
    context: str  # words that raise the score by 0.4
    base: bool = True


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.9,
        r"e-?mail|mail|contact|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        "[0-9]",
        0.6,
        r"ip|address|host|server|adresse|dirección",
    ),
    Kind("card", r"[0-9](?:[ -]?+[0-9])++", "[0-9]", 0.8, r"card|visa|credit|karte|carte|tarjeta|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+", 0.7, r"phone|tel|mobile|call|fax|telefon|téléphone|teléfono"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        "[0-9]",
        0.8,
        r"iban|account|bank|konto|compte|cuenta",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "[0-9]",
        0.2,
        r"ssn|social security|social insurance",
        base=False,
    ),
    Kind(
        "local_phone",
        r"(?<![0-9-])(?:\([0-9]{3}\) ?|[0-9]{3}[ -])[0-9]{3}-[0-9]{4}(?![0-9-])",
        "[0-9]",
        0.2,
        r"phone|tel|mobile|call|fax|telefon|téléphone|teléfono",
        base=False,
    ),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)


def _confirmed(kind: str, s: Column) -> Column:
    """Whether the matched text ``s`` holds what its kind asks for."""
    digits = F.length(F.regexp_replace(s, "[^0-9]", ""))
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda part: part.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$"))
    if kind == "card":
        return F.when(digits.between(12, 19), F.call_function("luhn_check", F.regexp_replace(s, "[ -]", ""))).otherwise(F.lit(False))
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "iban":
        plain = F.regexp_replace(s, " ", "")
        turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
        # mod-97 over the text with A = 10 ... Z = 35, character by character.
        rest = F.aggregate(
            F.split(turned, ""),
            F.lit(0),
            lambda r, c: F.when(c == "", r)
            .when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97)
            .otherwise((r * 100 + F.ascii(c) - 55) % 97),
        )
        return F.length(plain).between(15, 34) & (rest == 1)
    if kind == "ssn":
        return ~s.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _spans(matches: Column, pieces: Column, order: int, kind: Kind) -> Column:
    """Confirmed spans of one kind, by start: ``matches``, with the ``pieces`` of
    the text before, between and after them."""
    paired = F.slice(F.zip_with(pieces, matches, lambda gap, s: F.struct(gap.alias("gap"), s.alias("s"))), F.lit(1), F.size(matches))

    def placed(state: Column, z: Column) -> tuple[Column, Column]:
        before = F.right(F.concat(state["before"], z["gap"]), F.lit(CONTEXT))
        start = state["at"] + F.length(z["gap"])
        n = F.length(z["s"])
        after = F.struct((start + n).alias("at"), F.right(F.concat(before, z["s"]), F.lit(CONTEXT)).alias("before"))
        return after, F.struct(start, n, z["s"], before)

    begin = F.struct(F.lit(0), F.lit(""))
    found = scan(paired, begin, "struct<at:int,before:string>", "struct<start:int,n:int,s:string,before:string>", placed)

    def scored(z: Column) -> Column:
        near = F.lower(z["before"]).rlike(rf"(?<!\p{{L}})(?:{kind.context})(?!\p{{L}})")
        score = F.lit(kind.score) + F.when(near, F.lit(0.4)).otherwise(F.lit(0.0))
        return F.struct(
            z["start"].alias("start"),
            F.lit(order).alias("kind_order"),
            (z["start"] + z["n"]).alias("end"),
            F.lit(kind.name).alias("kind"),
            F.least(F.lit(1.0), score).alias("score"),
        )

    found = F.transform(F.filter(found, lambda z: _confirmed(kind.name, z["s"])), scored)
    return found if kind.base else F.filter(found, lambda z: z["score"] >= THRESHOLD)


def _apart(spans: Column) -> Column:
    """``spans`` (sorted) without added ones that overlap a base span."""
    base = lambda z: z["kind_order"] < len(BASE_KINDS)
    flagged = f"struct<z:{SPAN},ok:boolean>"

    def forwards(reached: Column, z: Column) -> tuple[Column, Column]:
        ok = base(z) | (z["kind"] == "iban") | (z["start"] >= reached)
        return F.when(base(z), F.greatest(reached, z["end"])).otherwise(reached), F.struct(z, ok)

    def backwards(following: Column, f: Column) -> tuple[Column, Column]:
        z = f["z"]
        ok = f["ok"] & (base(z) | (z["kind"] == "iban") | (z["end"] <= following))
        return F.when(base(z), z["start"]).otherwise(following), F.struct(z, ok)

    there = scan(spans, F.lit(0), "int", flagged, forwards)
    both = scan(F.reverse(there), F.lit(2**31 - 1), "int", flagged, backwards)
    return F.transform(F.filter(F.reverse(both), lambda f: f["ok"]), lambda f: f["z"])


def find_spans(docs: DataFrame, *keep: Column) -> DataFrame:
    """(*keep, body, base, spans) of ``docs`` (a column ``text``): ``base``
    holds the spans of base kinds, ``spans`` all, both by start and kind."""
    none = F.array().cast(f"array<{SPAN}>")
    df = docs.select(*keep, F.coalesce("text", F.lit("")).alias("body"))
    df = df.withColumns({f"maybe_{i}": F.col("body").rlike(m) for i, m in enumerate(sorted({k.maybe for k in KINDS}))})
    maybe = {m: F.col(f"maybe_{i}") for i, m in enumerate(sorted({k.maybe for k in KINDS}))}
    df = df.withColumns(
        {
            f"m_{k.name}": F.when(maybe[k.maybe], F.regexp_extract_all("body", F.lit(k.pattern), F.lit(0)))
            for k in KINDS
        }
    )
    df = df.withColumns(
        {
            f"g_{k.name}": F.when(F.size(f"m_{k.name}") > 0, F.split("body", k.pattern, -1))
            for k in KINDS
        }
    )
    df = df.withColumns(
        {
            f"s_{k.name}": F.when(
                F.size(f"m_{k.name}") > 0, _spans(F.col(f"m_{k.name}"), F.col(f"g_{k.name}"), i, k)
            ).otherwise(none)
            for i, k in enumerate(KINDS)
        }
    )
    df = df.withColumn("base", F.sort_array(F.concat(*(F.col(f"s_{k.name}") for k in KINDS if k.base))))

    df = df.withColumn("added", F.concat(*(F.col(f"s_{k.name}") for k in KINDS if not k.base)))
    every = F.sort_array(F.concat("base", "added"))
    spans = F.when(F.size("added") == 0, F.col("base")).when(F.size("base") == 0, F.sort_array("added")).otherwise(_apart(every))
    df = df.withColumn("spans", spans).drop("added")
    return df.drop(*(c for c in df.columns if c[:2] in ("m_", "g_", "s_") or c.startswith("maybe_")))


def told(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda z: F.concat_ws(":", z["kind"], z["start"], z["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda z: z["kind"] == kind)).cast("long")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind, as ``[EMAIL]``; n_chars
    follows the new text. Rows without spans are unchanged."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    found = find_spans(docs, row.alias("carried"))

    def put(reached: Column, z: Column) -> tuple[Column, Column]:
        """The text to copy before the span, and what stands for the span."""
        name = F.when(z["start"] >= reached, F.concat(F.lit("["), F.upper(z["kind"]), F.lit("]"))).otherwise(F.lit(""))
        return F.greatest(reached, z["end"]), F.struct(reached, F.greatest(reached, z["start"]), name)

    cuts = scan(F.col("spans"), F.lit(0), "int", "struct<from:int,to:int,name:string>", put)
    end = F.struct(F.array_max(F.transform("spans", lambda z: z["end"])), F.length("body"), F.lit(""))
    cuts = F.concat(cuts, F.array(end.cast("struct<from:int,to:int,name:string>")))
    clean = cutter(
        F.col("body"),
        lambda cut: F.array_join(F.transform(cuts, lambda c: F.concat(cut(c["from"], c["to"]), c["name"])), ""),
    )
    hit = F.size("spans") > 0
    found = found.withColumn("clean", F.when(hit, clean).otherwise(F.col("carried.text")))
    out = []
    for c in docs.columns:
        old = F.col("carried")[c]
        new = {"text": F.col("clean"), "n_chars": F.when(hit, F.length("clean").cast("long")).otherwise(old)}
        out.append(new.get(c, old).alias(c))
    return found.select(*out)
