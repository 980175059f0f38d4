"""Readers of the other ontology serialisations: N-Triples, Turtle, OBO, OWL/XML, functional and Manchester syntax.

All give the triples that RDF/XML has for the same axioms, so everything behind
them is the same. Each is a scanner (one pattern for all tokens) and a small
recursive reader. What a reader doesn't know raises ValueError, and the
document becomes a row with a reason (``rdf.parsed``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from xml.etree import ElementTree as ET

from pyspark.sql import Column

from ontoloom.sources import rdf
from ontoloom.sources.archives import Clock
from ontoloom.sources.rdf import RDF, XML, Triples

# Public vocabularies and the prefixes that all forms know.
RDFS, OWL, XSD = "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#", "http://www.w3.org/2001/XMLSchema#"
OBO, OIO = "http://purl.obolibrary.org/obo/", "http://www.geneontology.org/formats/oboInOwl#"
PREFIXES = {"rdf": RDF, "rdfs": RDFS, "owl": OWL, "xsd": XSD, "xml": XML[1:-1], "obo": OBO, "oboInOwl": OIO}

_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


def _unescape(text: str) -> str:
    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _ESCAPES.get(m[3], m[3]), text)


_TOKEN = re.compile(r"""
    (?P<blank>[\s\ufeff]+|\#[^\n]*)
  | (?P<iri><[^<>"{}|^`\\\s]*>)
  | (?P<string>\"\"\"(?:(?:\"|\"\")?(?:[^"\\]|\\.))*\"\"\"|\'\'\'(?:(?:\'|\'\')?(?:[^'\\]|\\.))*\'\'\'|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
  | (?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
  | (?P<type>\^\^)
  | (?P<node>_:[\w][\w.\-]*)
  | (?P<number>[+-]?(?:\d+\.\d*(?:[eE][+-]?\d+)?|\.?\d+(?:[eE][+-]?\d+)?)(?![\w:]))
  | (?P<name>(?:[^\W\d_][\w.\-]*)?:(?:[\w:%\-]|\\.|\.(?=[\w:%\-]))*)
  | (?P<word>[A-Za-z_][\w\-]*)
  | (?P<mark>[.;,()\[\]={}])
""", re.X | re.S)


class _Scan:
    """The tokens of a document as (kind, text), one ahead."""

    def __init__(self, text: str, clock: Clock):
        self.text, self.at, self.clock, self.count = text, 0, clock, 0
        self.now = self._next()

    def _next(self) -> tuple[str, str]:
        while self.at < len(self.text):
            m = _TOKEN.match(self.text, self.at)
            if m is None:
                raise ValueError(f"unexpected {self.text[self.at : self.at + 20]!r}")
            self.at = m.end()
            if m.lastgroup != "blank":
                return m.lastgroup, m[0]
        return "end", ""

    def take(self, *wanted: str) -> tuple[str, str]:
        """The current token, which has to be one of some texts, if any are given."""
        self.count += 1
        if self.count % 4096 == 0:
            self.clock.check()
        now = self.now
        if wanted and now[1] not in wanted or now[0] == "end" and not wanted:
            raise ValueError(f"{now[1]!r} instead of {wanted}")
        self.now = self._next()
        return now

    def skip(self, text: str) -> bool:
        if self.now[1] == text:
            self.take()
            return True
        return False


class _Names:
    """Prefixes and base of a document."""

    def __init__(self, out: Triples):
        self.out, self.prefixes = out, dict(PREFIXES)

    def iri(self, kind: str, text: str) -> str:
        if kind == "iri":
            return self.out.full(_unescape(text[1:-1]))
        if kind == "name":
            prefix, local = text.split(":", 1)
            if prefix not in self.prefixes:
                raise ValueError(f"no prefix {prefix!r}")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        raise ValueError(f"{text!r} is no name")

    def literal(self, scan: _Scan, text: str) -> tuple[str, bool, str | None, str | None]:
        """(value, True, datatype, language), with what follows the string."""
        cut = 3 if text[:3] in ('"""', "'''") else 1
        value = _unescape(text[cut:-cut])
        if scan.now[0] == "lang":
            return value, True, None, scan.take()[1][1:]
        if scan.skip("^^"):
            return value, True, self.iri(*scan.take()), None
        return value, True, None, None


# --- N-Triples and Turtle ---------------------------------------------------------


class _Turtle:
    def __init__(self, text: str, clock: Clock):
        self.out = Triples(clock=clock)
        self.names, self.scan = _Names(self.out), _Scan(text, clock)

    def document(self) -> None:
        scan = self.scan
        while scan.now[0] != "end":
            kind, text = scan.now
            word = text.lstrip("@").lower()
            if kind in ("lang", "word") and word in ("prefix", "base"):
                scan.take()
                if word == "prefix":
                    name = scan.take()[1]
                    self.names.prefixes[name[:-1]] = self.names.iri(*scan.take())
                else:
                    self.out.base = self.names.iri(*scan.take())
                if kind == "lang":
                    scan.take(".")
                continue
            bare = text == "["
            subject = self.thing()[0]
            if not (bare and scan.now[1] == "."):
                self.properties(subject)
            scan.take(".")

    def properties(self, subject: str) -> None:
        while True:
            kind, text = self.scan.take()
            predicate = RDF + "type" if (kind, text) == ("word", "a") else self.names.iri(kind, text)
            while True:
                self.out.add(subject, predicate, *self.thing())
                if not self.scan.skip(","):
                    break
            while self.scan.skip(";"):
                pass
            if self.scan.now[1] in (".", "]") or self.scan.now[0] == "end":
                return

    def thing(self) -> tuple:
        scan = self.scan
        kind, text = scan.take()
        if kind == "node":
            return (text,)
        if kind == "string":
            return self.names.literal(scan, text)
        if kind == "number":
            return text, True, XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"), None
        if kind == "word" and text in ("true", "false"):
            return text, True, XSD + "boolean", None
        if text == "[":
            blank = self.out.new()
            if scan.now[1] != "]":
                self.properties(blank)
            scan.take("]")
            return (blank,)
        if text == "(":
            head = cell = None
            while not scan.skip(")"):
                new = self.out.new()
                if cell:
                    self.out.add(cell, RDF + "rest", new)
                head, cell = head or new, new
                self.out.add(cell, RDF + "first", *self.thing())
            if cell:
                self.out.add(cell, RDF + "rest", RDF + "nil")
            return (head or RDF + "nil",)
        return (self.names.iri(kind, text),)


def turtle(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """Turtle, and N-Triples, which is a part of it."""
    reader = _Turtle(text, clock or Clock(0))
    reader.document()
    return reader.out.apart(prefix)


# --- OBO --------------------------------------------------------------------------

_SCOPES = {"EXACT": "hasExactSynonym", "BROAD": "hasBroadSynonym", "NARROW": "hasNarrowSynonym", "RELATED": "hasRelatedSynonym"}
_QUOTED = re.compile(r'"((?:[^"\\]|\\.)*)"\s*(.*)', re.S)


def obo(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """OBO 1.4: terms and typedefs with their tags."""
    out = Triples(clock=clock)
    head, stanzas, now = {}, [], None
    for line in text.splitlines():
        line = re.sub(r"(?<!\\)\s!\s.*$", "", line).strip() if not _QUOTED.search(line) else line.strip()
        if re.fullmatch(r"\[\w+\]", line):
            now = (line[1:-1], [])
            stanzas.append(now)
        elif line and line[0] != "!":
            tag, colon, value = line.partition(":")
            if not colon:
                raise ValueError(f"no tag in {line[:40]!r}")
            if now is None:
                head.setdefault(tag.strip(), value.strip())
            else:
                now[1].append((tag.strip(), re.sub(r"\s*(?<!\\)\{[^{}]*\}\s*$", "", value.strip())))

    def iri(name: str) -> str:
        name = name.strip()
        if "://" in name:
            return name
        space, colon, local = name.partition(":")
        return f"{OBO}{space}_{local}" if colon else f"{OBO}{head.get('ontology', '')}#{name}"

    def some(relation: str, target: str) -> str:
        node = out.new()
        out.add(node, RDF + "type", OWL + "Restriction")
        out.add(node, OWL + "onProperty", iri(relation))
        out.add(node, OWL + "someValuesFrom", iri(target))
        return node

    for kind, tags in stanzas:
        ids = [v for t, v in tags if t == "id"]
        if not ids:
            raise ValueError("a stanza without id")
        s, term = iri(ids[0]), kind == "Term"
        out.add(s, RDF + "type", OWL + ("Class" if term else "ObjectProperty" if kind == "Typedef" else "NamedIndividual"))
        parts = []
        for tag, value in tags:
            quoted = _QUOTED.match(value)
            words = value.split()
            if tag == "name":
                out.add(s, RDFS + "label", value, True)
            elif tag == "def" and quoted:
                out.add(s, OBO + "IAO_0000115", _unescape(quoted[1]), True)
            elif tag == "comment":
                out.add(s, RDFS + "comment", value, True)
            elif tag == "synonym" and quoted:
                out.add(s, OIO + _SCOPES.get((quoted[2].split() or ["RELATED"])[0], "hasRelatedSynonym"), _unescape(quoted[1]), True)
            elif tag == "xref":
                out.add(s, OIO + "hasDbXref", words[0], True)
            elif tag == "is_a":
                out.add(s, RDFS + ("subClassOf" if term else "subPropertyOf"), iri(words[0]))
            elif tag == "instance_of":
                out.add(s, RDF + "type", iri(words[0]))
            elif tag == "relationship":
                out.add(s, RDFS + "subClassOf", some(words[0], words[1]))
            elif tag == "intersection_of":
                parts.append(iri(words[0]) if len(words) == 1 else some(words[0], words[1]))
            elif tag == "equivalent_to":
                out.add(s, OWL + "equivalentClass", iri(words[0]))
            elif tag == "disjoint_from":
                out.add(s, OWL + "disjointWith", iri(words[0]))
            elif tag in ("domain", "range"):
                out.add(s, RDFS + tag, iri(words[0]))
            elif tag == "inverse_of":
                out.add(s, OWL + "inverseOf", iri(words[0]))
            elif tag == "is_obsolete" and value == "true":
                out.add(s, OWL + "deprecated", "true", True, XSD + "boolean")
        if parts:
            node = out.new()
            out.add(s, OWL + "equivalentClass", node)
            out.add(node, RDF + "type", OWL + "Class")
            out.add(node, OWL + "intersectionOf", out.members(parts))
    return out.apart(prefix)


# --- axioms: OWL/XML and functional syntax give trees, Manchester syntax calls directly --------


class _Axioms:
    """OWL axioms as triples. Expressions come as names of nodes, literals as tuples (value, True, datatype, language)."""

    #: Of axioms between two expressions: the predicate of their triple.
    PAIRS = {
        "SubClassOf": RDFS + "subClassOf", "SubObjectPropertyOf": RDFS + "subPropertyOf", "SubDataPropertyOf": RDFS + "subPropertyOf", "SubAnnotationPropertyOf": RDFS + "subPropertyOf",
        "ObjectPropertyDomain": RDFS + "domain", "ObjectPropertyRange": RDFS + "range", "DataPropertyDomain": RDFS + "domain", "DataPropertyRange": RDFS + "range",
        "InverseObjectProperties": OWL + "inverseOf", "EquivalentClasses": OWL + "equivalentClass", "EquivalentObjectProperties": OWL + "equivalentProperty",
        "EquivalentDataProperties": OWL + "equivalentProperty", "DisjointClasses": OWL + "disjointWith", "SameIndividual": OWL + "sameAs", "DifferentIndividuals": OWL + "differentFrom",
    }
    CHARACTERISTICS = ("Functional", "InverseFunctional", "Transitive", "Symmetric", "Asymmetric", "Reflexive", "Irreflexive")
    LISTS = {"ObjectIntersectionOf": "intersectionOf", "ObjectUnionOf": "unionOf", "ObjectOneOf": "oneOf"}
    RESTRICTIONS = {"SomeValuesFrom": "someValuesFrom", "AllValuesFrom": "allValuesFrom", "HasValue": "hasValue", "HasSelf": "hasSelf"}
    ENTITIES = {"Class": "Class", "ObjectProperty": "ObjectProperty", "DataProperty": "DatatypeProperty", "AnnotationProperty": "AnnotationProperty", "NamedIndividual": "NamedIndividual", "Datatype": "Datatype"}

    def __init__(self, out: Triples):
        self.out = out

    def declare(self, kind: str, iri: str) -> None:
        self.out.add(iri, RDF + "type", (RDFS if kind == "Datatype" else OWL) + self.ENTITIES[kind])

    def restriction(self, prop: str, how: str, what) -> str:
        node = self.out.new()
        self.out.add(node, RDF + "type", OWL + "Restriction")
        self.out.add(node, OWL + "onProperty", prop)
        self.out.add(node, OWL + how, *(what if isinstance(what, tuple) else (what,)))
        return node

    def listed(self, how: str, parts: list[str]) -> str:
        node = self.out.new()
        self.out.add(node, RDF + "type", OWL + "Class")
        self.out.add(node, OWL + how, self.out.members(parts))
        return node

    def complement(self, part: str) -> str:
        node = self.out.new()
        self.out.add(node, RDF + "type", OWL + "Class")
        self.out.add(node, OWL + "complementOf", part)
        return node

    def expression(self, name: str, parts: list):
        if name in self.LISTS:
            return self.listed(self.LISTS[name], parts)
        if name == "ObjectComplementOf":
            return self.complement(parts[0])
        if name == "ObjectInverseOf":
            node = self.out.new()
            self.out.add(node, OWL + "inverseOf", parts[0])
            return node
        short = re.sub("^(Object|Data)", "", name)
        if short in self.RESTRICTIONS:
            what = parts[1] if len(parts) > 1 else ("true", True, XSD + "boolean", None)
            return self.restriction(parts[0], self.RESTRICTIONS[short], what)
        raise ValueError(f"unknown expression {name}")

    def cardinality(self, name: str, n: str, prop: str, what: str | None) -> str:
        how = re.sub("^(Object|Data)", "", name)
        how = {"MinCardinality": "minCardinality", "MaxCardinality": "maxCardinality", "ExactCardinality": "cardinality"}[how]
        qualified = {"cardinality": "qualifiedCardinality"}.get(how, how[:3] + "Qualified" + how[3:]) if what else how
        node = self.restriction(prop, qualified, (n, True, XSD + "nonNegativeInteger", None))
        if what:
            self.out.add(node, OWL + "onClass", what)
        return node

    def axiom(self, name: str, parts: list) -> None:
        out = self.out
        if name in self.PAIRS:
            for a, b in zip(parts, parts[1:], strict=False):
                out.add(a, self.PAIRS[name], b)
        elif name == "ClassAssertion":
            out.add(parts[1], RDF + "type", parts[0])
        elif name in ("ObjectPropertyAssertion", "DataPropertyAssertion", "AnnotationAssertion"):
            p, s, o = parts
            out.add(s, p, *(o if isinstance(o, tuple) else (o,)))
        elif name.removesuffix("ObjectProperty") in self.CHARACTERISTICS:
            out.add(parts[0], RDF + "type", OWL + name.removesuffix("ObjectProperty") + "Property")


def owl_xml(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """OWL/XML."""
    root = ET.fromstring(text)
    out = Triples(root.attrib.get(XML + "base", ""), clock)
    names, axioms = _Names(out), _Axioms(out)
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    if local(root) != "Ontology":
        raise ValueError("no Ontology")
    for e in root:
        if local(e) == "Prefix":
            names.prefixes[e.attrib.get("name", "")] = e.attrib["IRI"]

    def iri(e) -> str:
        if "IRI" in e.attrib:
            return out.full(e.attrib["IRI"])
        return names.iri("name", e.attrib["abbreviatedIRI"])

    def part(e):
        name = local(e)
        if name in _Axioms.ENTITIES:
            return iri(e)
        if name == "IRI":
            return out.full((e.text or "").strip())
        if name == "AbbreviatedIRI":
            return names.iri("name", (e.text or "").strip())
        if name == "AnonymousIndividual":
            return "_:" + e.attrib["nodeID"].removeprefix("_:")
        if name == "Literal":
            return e.text or "", True, e.attrib.get("datatypeIRI"), e.attrib.get(XML + "lang")
        if name.endswith("Cardinality"):
            inner = [part(c) for c in e]
            return axioms.cardinality(name, e.attrib["cardinality"], inner[0], inner[1] if len(inner) > 1 else None)
        return axioms.expression(name, [part(c) for c in e])

    for e in root:
        name = local(e)
        if name == "Declaration":
            axioms.declare(local(e[0]), iri(e[0]))
        elif name not in ("Prefix", "Import", "Annotation"):
            axioms.axiom(name, [part(c) for c in e if local(c) != "Annotation"])
    return out.apart(prefix)


def functional(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """OWL functional syntax."""
    out = Triples(clock=clock)
    names, axioms, scan = _Names(out), _Axioms(out), _Scan(text, clock or Clock(0))

    def part():
        kind, word = scan.take()
        if kind == "node":
            return word
        if kind == "string":
            return names.literal(scan, word)
        if kind != "word":
            return names.iri(kind, word)
        scan.take("(")
        if word.endswith("Cardinality"):
            n, prop = scan.take()[1], part()
            what = None if scan.now[1] == ")" else part()
            scan.take(")")
            return axioms.cardinality(word, n, prop, what)
        return axioms.expression(word, rest())

    def rest() -> list:
        """The parts up to the closing bracket, without annotations."""
        parts = []
        while not scan.skip(")"):
            if scan.now == ("word", "Annotation"):
                scan.take()
                scan.take("(")
                rest()
            else:
                parts.append(part())
        return parts

    while scan.now[0] != "end" and scan.take("Prefix", "Ontology")[1] == "Prefix":
        scan.take("(")
        name = scan.take()[1]
        scan.take("=")
        names.prefixes[name[:-1]] = names.iri(*scan.take())
        scan.take(")")
    scan.take("(")
    while scan.now[0] == "iri":
        scan.take()
    while not scan.skip(")"):
        name = scan.take()[1]
        scan.take("(")
        if name == "Declaration":
            kind = scan.take(*_Axioms.ENTITIES)[1]
            scan.take("(")
            axioms.declare(kind, part())
            scan.take(")")
            scan.take(")")
        elif name in ("Import", "Annotation"):
            rest()
        else:
            axioms.axiom(name, rest())
    return out.apart(prefix)


_FRAMES = {"Class": "Class", "ObjectProperty": "ObjectProperty", "DataProperty": "DataProperty", "AnnotationProperty": "AnnotationProperty", "Individual": "NamedIndividual", "Datatype": "Datatype"}
_SECTIONS = {
    "SubClassOf": RDFS + "subClassOf", "EquivalentTo": OWL + "equivalentClass", "DisjointWith": OWL + "disjointWith", "SubPropertyOf": RDFS + "subPropertyOf",
    "Domain": RDFS + "domain", "Range": RDFS + "range", "InverseOf": OWL + "inverseOf", "Types": RDF + "type", "SameAs": OWL + "sameAs",
}
_HOW = {"some": "someValuesFrom", "only": "allValuesFrom", "value": "hasValue"}
_COUNT = {"min": "MinCardinality", "max": "MaxCardinality", "exactly": "ExactCardinality"}


def manchester(text: str, prefix: str = "", clock: Clock | None = None) -> list[dict]:
    """OWL Manchester syntax."""
    out = Triples(clock=clock)
    names, axioms, scan = _Names(out), _Axioms(out), _Scan(text, clock or Clock(0))
    # a keyword such as SubClassOf: scans as a name with an empty local part
    keyword = lambda: scan.now[0] == "name" and scan.now[1][-1] == ":" and (scan.now[1][:-1] in _FRAMES or scan.now[1][:-1] in _SECTIONS or scan.now[1][:-1] in ("Prefix", "Ontology", "Import", "Annotations", "Facts", "Characteristics", "EquivalentClasses", "DisjointClasses"))

    def name() -> str:
        kind, word = scan.take()
        return word if kind == "node" else names.iri("name", ":" + word) if kind == "word" else names.iri(kind, word)

    def joined(word: str, how: str, inner: Callable[[], str]) -> str:
        parts = [inner()]
        while scan.skip(word):
            parts.append(inner())
        return parts[0] if len(parts) == 1 else axioms.listed(how, parts)

    def expression() -> str:
        return joined("or", "unionOf", lambda: joined("and", "intersectionOf", primary))

    def primary() -> str:
        if scan.skip("not"):
            return axioms.complement(primary())
        if scan.skip("("):
            inner = expression()
            scan.take(")")
            return inner
        if scan.skip("{"):
            parts = [name()]
            while scan.skip(","):
                parts.append(name())
            scan.take("}")
            return axioms.listed("oneOf", parts)
        first = name()
        word = scan.now[1]
        if word in _HOW:
            scan.take()
            literal = scan.now[0] == "string"
            return axioms.restriction(first, _HOW[word], names.literal(scan, scan.take()[1]) if literal else primary())
        if word in _COUNT:
            scan.take()
            n = scan.take()[1]
            plain = scan.now[0] == "end" or scan.now[1] in (",", ")", "and", "or") or keyword()
            return axioms.cardinality(_COUNT[word], n, first, None if plain else primary())
        return first

    def facts(subject: str) -> None:
        while True:
            p = name()
            out.add(subject, p, *(names.literal(scan, scan.take()[1]) if scan.now[0] == "string" else (name(),)))
            if not scan.skip(","):
                return

    subject = None
    while scan.now[0] != "end":
        word = scan.take()[1][:-1]
        if word == "Prefix":
            p = scan.take()[1][:-1]
            names.prefixes[p] = names.iri(*scan.take())
        elif word in ("Ontology", "Import"):
            while scan.now[0] == "iri":
                scan.take()
        elif word in _FRAMES:
            subject = name()
            axioms.declare(_FRAMES[word], subject)
        elif word in ("EquivalentClasses", "DisjointClasses"):
            parts = [expression()]
            while scan.skip(","):
                parts.append(expression())
            axioms.axiom(word, parts)
        elif word in ("Annotations", "Facts"):
            if subject is None:
                subject = out.new()
            facts(subject)
        elif word == "Characteristics":
            while True:
                out.add(subject, RDF + "type", OWL + scan.take()[1] + "Property")
                if not scan.skip(","):
                    break
        elif word in _SECTIONS and subject is not None:
            while True:
                out.add(subject, _SECTIONS[word], expression())
                if not scan.skip(","):
                    break
        else:
            raise ValueError(f"unexpected {word!r}")
    return out.apart(prefix)


# --- any of them ------------------------------------------------------------------

#: Readers by what a document begins with, then by the extension of its name.
BY_EXTENSION = {".ttl": turtle, ".n3": turtle, ".nt": turtle, ".obo": obo, ".ofn": functional, ".omn": manchester, ".owx": owl_xml}


def reader(text: str, extension: str) -> Callable[[str, str, Clock], list[dict]]:
    head = re.sub(r"<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^\[>]*(?:\[.*?\])?\s*>", "", text[:20_000], flags=re.S).lstrip("\ufeff \t\r\n")
    if re.match(r"<(?:\w+:)?RDF\b|<rdf:", head):
        return rdf.parse
    if re.match(r"<(?:\w+:)?Ontology\b", head):
        return owl_xml
    if re.match(r"format-version\s*:", head):
        return obo
    if re.match(r"(?:Prefix|Ontology)\s*\(", head):
        return functional
    if re.match(r"(?:Prefix|Ontology|Class)\s*:\s", head) and not re.match(r"prefix\s", head):
        return manchester
    if head.startswith("<") and re.match(r"<[A-Za-z!?/][^<>]*>\s*<", head) is None and re.match(r"<[A-Za-z][\w.\-]*[\s/>]", head):
        return rdf.parse
    return BY_EXTENSION.get(extension, turtle if re.match(r"@prefix|@base|PREFIX\s|BASE\s|_:|#", head) or re.match(r"<[^<>\s]+>\s", head) else rdf.parse)


def any_form(text: str, prefix: str = "", clock: Clock | None = None, extension: str = "") -> list[dict]:
    return reader(text, extension)(text, prefix, clock or Clock(0))


FORMS = {"rdf_xml": rdf.parse, "turtle": turtle, "obo": obo, "owl_xml": owl_xml, "functional": functional, "manchester": manchester, "any": any_form}


def triples(text: Column, prefix: Column, form: str = "any", seconds: float = 0) -> Column:
    """struct(ok, reason, triples) for documents of one form, or of any, told by their beginnings."""
    return rdf.parsed(FORMS[form], text, prefix, seconds)
