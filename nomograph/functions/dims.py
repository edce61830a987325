"""Fixed dimensions of the domain: authority codes and labels, languages, relation types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORITY = "http://publications.europa.eu/resource/authority"
TYPE = f"{AUTHORITY}/resource-type/"
BODY = f"{AUTHORITY}/corporate-body/"
ENGLISH = f"{AUTHORITY}/language/ENG"
CONCEPT = "http://eurovoc.europa.eu/"
ELI = "http://data.europa.eu/eli/"

# Labels of resource types and corporate bodies by authority code.
TYPE_LABELS = {
    "REG": "Regulation",
    "DIR": "Directive",
    "DEC": "Decision",
    "TREATY": "Treaty",
    "JUDG": "Judgment",
    "ORDER": "Order",
    "OPIN_AG": "AG Opinion",
    "AG_OPI": "AG Opinion",
    "VIEW_AG": "AG View",
    "RULING": "Ruling",
    "PROP_DIR": "Proposal",
    "REC_SOFT": "Recommendation",
    "RES": "Resolution",
    "AGREE_INTERNATION": "International Agreement",
    "REG_IMPL": "Implementing Regulation",
    "REG_DEL": "Delegated Regulation",
    "INFO_JUDICIAL": "Judicial Information Notice",
    "INFO_JUR": "Information Notice",
    "ABSTRACT_JUR": "Case Abstract",
    "SUM_JUR": "Case Summary",
}
BODY_LABELS = {
    "EP": "European Parliament",
    "CONSIL": "Council of the EU",
    "COM": "European Commission",
    "CURIA": "Court of Justice of the EU",
    "ECB": "European Central Bank",
    "EIB": "European Investment Bank",
    "ECA": "European Court of Auditors",
    "ESC": "European Economic and Social Committee",
    "COR": "Committee of the Regions",
    "EURATOM": "Euratom",
    "SRB": "Single Resolution Board",
    "ESMA": "European Securities and Markets Authority",
    "EBA": "European Banking Authority",
    "EIOPA": "European Insurance and Occupational Pensions Authority",
    "ECDC": "European Centre for Disease Prevention and Control",
    "EEA": "European Environment Agency",
    "EASA": "European Union Aviation Safety Agency",
    "EFSA": "European Food Safety Authority",
    "EMA": "European Medicines Agency",
    "EMEA": "European Medicines Agency",
    "FRONTEX": "Frontex",
    "EUIPO": "European Union Intellectual Property Office",
    "ETF": "European Training Foundation",
    "EASO": "European Asylum Support Office",
    "ESTAT": "Eurostat",
    "JUST": "DG Justice",
    "GROW": "DG Internal Market",
    "SANTE": "DG Health and Food Safety",
    "COMP": "DG Competition",
    "FISMA": "DG Financial Stability",
    "TRADE": "DG Trade",
}
# Document types offered as a filter, case types, derivative case records.
DOCUMENT_TYPES = {"REG": "REG", "DIR": "DIR", "DEC": "DEC", "TREATY": "TREATY", "JUDG": "JUDG", "OPIN_AG": "OPIN_AG", "PROP": "PROP_DIR", "REC": "REC_SOFT"}
CONSOLIDATED_TYPE = "CONS_TEXT"
CASE_TYPES = {"judgment": "JUDG", "order": "ORDER", "ag_opinion": "OPIN_AG"}
DERIVATIVE_TYPES = ("INFO_JUDICIAL", "INFO_JUR", "ABSTRACT_JUR", "SUM_JUR", "CORRIGENDUM")
COURTS = {"CJEU": ("CJ", "CC", "CO"), "GC": ("TJ", "TO")}
# ISO 639-2 terminological codes of the official languages.
LANGUAGES = {
    "EN": "eng", "FR": "fra", "DE": "deu", "ES": "spa", "IT": "ita", "PL": "pol", "PT": "por", "NL": "nld",
    "CS": "ces", "DA": "dan", "EL": "ell", "ET": "est", "FI": "fin", "HU": "hun", "LT": "lit", "LV": "lav",
    "MT": "mlt", "RO": "ron", "SK": "slk", "SL": "slv", "SV": "swe", "BG": "bul", "HR": "hrv", "GA": "gle",
}
# Media types tried for each format, in order.
MEDIA_TYPES = {"html": ("application/xhtml+xml", "text/html"), "xml": ("application/xml;type=fmx4",)}
# Relation type -> (predicate, direction), in the order of the default request.
RELATIONS = {
    "cites": ("work_cites_work", "both"),
    "amends": ("resource_legal_amends_resource_legal", "outgoing"),
    "amended_by": ("resource_legal_amends_resource_legal", "incoming"),
    "repeals": ("resource_legal_repeals_resource_legal", "outgoing"),
    "repealed_by": ("resource_legal_repeals_resource_legal", "incoming"),
    "implicitly_repeals": ("resource_legal_implicitly_repeals_resource_legal", "outgoing"),
    "implicitly_repealed_by": ("resource_legal_implicitly_repeals_resource_legal", "incoming"),
    "legal_basis": ("resource_legal_based_on_resource_legal", "outgoing"),
    "consolidated_version": ("act_consolidated_consolidates_resource_legal", "incoming"),
}


def last_segment(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def label(uri: Column, namespace: str, labels: dict[str, str]) -> Column:
    """The label of an authority URI; of any other, its last path segment. A literal map: no join, no shuffle."""
    known = F.create_map(*[F.lit(x) for code, name in labels.items() for x in (namespace + code, name)])
    return F.coalesce(F.try_element_at(known, uri), last_segment(uri))


def type_label(uri: Column) -> Column:
    return label(uri, TYPE, TYPE_LABELS)


def body_label(uri: Column) -> Column:
    return label(uri, BODY, BODY_LABELS)


def type_labels(uris: Column) -> Column:
    """The labels of an array of type URIs: distinct, sorted, joined by a comma; null if there is none."""
    names = F.array_sort(F.array_distinct(F.transform(uris, type_label)))
    return F.when(F.size(uris) > 0, F.array_join(names, ", "))
