"""Controlled vocabularies. Fixed values, equal to those of the data's producers."""

from __future__ import annotations

# Sources too large or slow to transform.
GIANTS = (
    "NCBITAXON", "SNOMEDCT", "RXNORM", "MEDDRA", "NCIT", "LOINC", "GAZ", "PR",
    "DRON", "CPT", "ICD10", "ICD10CM", "OMIM", "MESH", "UMLS", "RH-MESH",
)

# Download and index statuses and reasons.
DOWNLOADED, SKIPPED, ERROR = "downloaded", "skipped", "error"
OK, FAILED, SKIP = "OK", "Failed", "Skipped"
LICENSED = "license_restricted"
LICENSE_CODES = (401, 403)
TOO_LARGE, TOO_SLOW = "too_large", "too_slow"

# File name extensions of ontology sources, prefixes of archive junk.
EXTENSIONS = (".owl", ".rdf", ".ttl", ".obo", ".owx", ".n3", ".nt", ".xml", ".omn", ".ofn")
JUNK = ("__MACOSX/", "._")

# The class of a format's chip; any other format has the first.
FORMAT_CLASS_DEFAULT = "kgx"
FORMAT_CLASS = {
    "kgx": "kgx", "kgx-jsonl": "jsonl", "json": "jsonl", "jsonld": "jsonl", "rdfxml": "rdf", "ttl": "rdf",
    "ntriples": "rdf", "nquads": "rdf", "neo4j": "neo4j", "duckdb": "duckdb", "sqlite": "duckdb", "mixed": "duckdb",
}

#: Short explanations of the reasons, in our own words.
REASON_TEXT = {
    "too_large": "The source is larger than the size limit.",
    "too_slow": "The transform ran into its time limit.",
    "skiplist": "The source is on the list of those known to be too large or slow.",
    "transform_error": "The transform reported an error.",
    "not_downloadable": "The catalogue offers no file for download.",
    "license_restricted": "The source's license doesn't allow its download; there is nothing to retry.",
    "no_download_file": "The latest submission has no source file.",
    "download_http_error": "The download had an unexpected response.",
    "no_submission": "The source has no submission.",
    "metadata_http_error": "The source's metadata could not be read.",
    "download_error": "The download failed.",
}
REASON_TEXT_DEFAULT = "This source has not been transformed."
