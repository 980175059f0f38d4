"""RDF/XML documents as triples, one row per triple, parsed inside the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urljoin
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ontoloom.functions import vocab as V
from ontoloom.sources.archives import Clock, TooSlow

# Names of the public RDF/XML syntax.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML = "{http://www.w3.org/XML/1998/namespace}"
_SYNTAX = {RDF + x for x in ("about", "ID", "nodeID", "resource", "parseType", "datatype", "RDF", "Description", "li")}

TRIPLE = "array<struct<s:string,p:string,o:string,literal:boolean,datatype:string,lang:string>>"


def _uri(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag


class Triples:
    """Collects triples; gives out blank nodes; minds the time."""

    def __init__(self, base: str = "", clock: Clock | None = None):
        self.base, self.out, self.blank, self.clock = base, [], 0, clock or Clock(0)

    def new(self) -> str:
        self.blank += 1
        return f"_:anon-{self.blank}"

    def full(self, ref: str) -> str:
        """An absolute reference as it is, another one against the base."""
        if ":" in ref.split("/")[0] or not self.base:
            return ref
        if ref[:1] == "#":  # also an empty fragment, which a prefix may be
            return self.base.split("#")[0] + ref
        return urljoin(self.base, ref)

    def add(self, s, p, o, literal=False, datatype=None, lang=None):
        if len(self.out) % 1024 == 0:
            self.clock.check()
        self.out.append({"s": s, "p": p, "o": o, "literal": literal, "datatype": datatype, "lang": lang})

    def members(self, items: list[str]) -> str:
        """The head of a new list."""
        cells = [self.new() for _ in items] + [RDF + "nil"]
        for cell, item, rest in zip(cells, items, cells[1:], strict=False):
            self.add(cell, RDF + "first", item)
            self.add(cell, RDF + "rest", rest)
        return cells[0]

    def apart(self, prefix: str) -> list[dict]:
        """The triples, blank nodes kept apart from others' by a prefix."""
        if prefix:
            for t in self.out:
                t["s"] = t["s"].replace("_:", f"_:{prefix}-", 1) if t["s"].startswith("_:") else t["s"]
                t["o"] = t["o"].replace("_:", f"_:{prefix}-", 1) if not t["literal"] and t["o"].startswith("_:") else t["o"]
        return self.out


class _Reader(Triples):
    """Striped syntax: node elements hold property elements, which hold nodes, literals or collections."""

    def node(self, e, lang) -> str:
        a = {_uri(k): v for k, v in e.attrib.items()}
        lang = e.attrib.get(XML + "lang", lang)
        s = self.full(a[RDF + "about"]) if RDF + "about" in a else self.full("#" + a[RDF + "ID"]) if RDF + "ID" in a else "_:" + a[RDF + "nodeID"] if RDF + "nodeID" in a else self.new()
        if _uri(e.tag) != RDF + "Description":
            self.add(s, RDF + "type", _uri(e.tag))
        for k, v in a.items():
            if k not in _SYNTAX and ":" in k and not k.startswith(XML[1:-1]):
                self.add(s, k, v, True, None, lang or None)
        items = 0
        for child in e:
            p = _uri(child.tag)
            if p == RDF + "li":
                items += 1
                p = f"{RDF}_{items}"
            self.property(s, p, child, lang)
        return s

    def property(self, s, p, e, lang):
        a = {_uri(k): v for k, v in e.attrib.items()}
        lang = e.attrib.get(XML + "lang", lang)
        kind = a.get(RDF + "parseType")
        if kind == "Literal":
            self.add(s, p, (e.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in e), True, RDF + "XMLLiteral")
        elif kind == "Resource":
            o = self.new()
            self.add(s, p, o)
            for child in e:
                self.property(o, _uri(child.tag), child, lang)
        elif kind == "Collection":
            self.add(s, p, self.members([self.node(c, lang) for c in e]))
        elif RDF + "resource" in a:
            self.add(s, p, self.full(a[RDF + "resource"]))
        elif RDF + "nodeID" in a:
            self.add(s, p, "_:" + a[RDF + "nodeID"])
        elif len(e):
            for child in e:
                self.add(s, p, self.node(child, lang))
        else:
            self.add(s, p, e.text or "", True, a.get(RDF + "datatype"), lang or None)


def parse(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """The triples of an RDF/XML document; ``prefix`` keeps its blank nodes apart from others'."""
    root = ET.fromstring(text)
    reader = _Reader(root.attrib.get(XML + "base", ""), clock)
    lang = root.attrib.get(XML + "lang", "")
    for e in root if _uri(root.tag) == RDF + "RDF" else [root]:
        reader.node(e, lang)
    return reader.apart(prefix)


PARSED = f"struct<ok:boolean,reason:string,triples:{TRIPLE}>"
_ITEM = pa.struct([("s", pa.string()), ("p", pa.string()), ("o", pa.string()), ("literal", pa.bool_()), ("datatype", pa.string()), ("lang", pa.string())])
_PARSED = pa.struct([("ok", pa.bool_()), ("reason", pa.string()), ("triples", pa.list_(_ITEM))])


def parsed(parser: Callable[[str, str, Clock], list[dict]], text: Column, prefix: Column, seconds: float = 0) -> Column:
    """struct(ok, reason, triples) for each document.

    One that can't be parsed, is nested too deep or takes too long isn't an error of the job.
    """

    def outcome(t: str, p: str) -> dict:
        try:
            return {"ok": True, "reason": "", "triples": parser(t, p, Clock(seconds))}
        except TooSlow:
            return {"ok": False, "reason": V.TOO_SLOW, "triples": []}
        except (ET.ParseError, ValueError, LookupError, RecursionError):
            return {"ok": False, "reason": "transform_error", "triples": []}

    @F.arrow_udf(PARSED)
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, prefixes in batches:
            for t, p in zip(texts, prefixes, strict=True):
                yield pa.array([outcome(t.as_py() or "", p.as_py() or "")], _PARSED)

    return of(text, prefix)


def triples(text: Column, prefix: Column, seconds: float = 0) -> Column:
    """The triples of RDF/XML documents, as ``parsed`` gives them."""
    return parsed(parse, text, prefix, seconds)
