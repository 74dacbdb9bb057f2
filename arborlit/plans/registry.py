"""The catalogue of results: what each shows, what is searched, how it is sorted."""

from __future__ import annotations

from dataclasses import dataclass, field

TREE = {"mesh_id": "MeSH ID", "web_id": "Web ID", "tree_id": "Tree ID", "count(*)": "Mentions", "first": "Category path"}


@dataclass(frozen=True)
class Result:
    id: str
    label: str
    result_format: str = "csv"
    columns: dict[str, str] = field(default_factory=dict)
    searchable: tuple[str, ...] = ()
    default_sort: str | None = None
    available: bool = True


def _tree(id_: str, label: str, columns: dict[str, str], key: str) -> Result:
    return Result(id_, label, "json-tree", columns, (key, "first"), "count(*)")


def _without(columns: dict[str, str], *names: str, **changed: str) -> dict[str, str]:
    return {k: changed.get(k, v) for k, v in columns.items() if k not in names}


def _genes(kind: str, label: str, drop: tuple[str, ...] = (), **changed: str) -> Result:
    return _tree(f"gene_tree_{kind}", label, {"gene_id": "Gene ID"} | _without(TREE, "mesh_id", *drop, **changed), "gene_id")


RESULTS = (
    Result(
        "documents",
        "Document metadata",
        columns={"pmid": "PMID", "title_e": "Title", "authors": "Authors", "journal": "Journal", "date": "Date", "doi": "DOI", "pmcid": "PMCID", "source": "Source", "fetch_status": "Status", "failure_reason": "Failure reason", "abstract": "Abstract"},
        searchable=("pmid", "title_e", "authors", "journal", "doi"),
        default_sort="pmid",
    ),
    _tree("mesh_tree", "Category tree", TREE, "mesh_id"),
    Result("mesh_subjects", "Subjects", "json-docs", {"pmid": "PMID", "title_e": "Title", "journal": "Journal", "subjects": "Subjects", "number_citations": "Citations"}, ("pmid", "title_e", "subjects"), "pmid"),
    Result("copy_categories", "Categories", "json-docs", {"pmid": "PMID", "title_e": "Title", "cat": "Category", "hard_category": "Hard category", "format": "Format"}, ("pmid", "title_e", "cat", "hard_category", "format"), "pmid"),
    Result(
        "predict_categories",
        "Predicted categories",
        "json-docs",
        {"pmid": "PMID", "title_e": "Title", "hard_category_predicted": "Predicted hard category", "hard_category_predicted_confidence": "Confidence", "format_predicted": "Predicted format", "format_predicted_confidence": "Confidence"},
        ("pmid", "title_e", "hard_category_predicted", "format_predicted"),
        "pmid",
    ),
    *(_tree(f"split_{x}", f"Tree: {x}", _without(TREE, "web_id"), "mesh_id") for x in ("diseases", "chemicals", "other")),
    _genes("go", "Gene tree: terms", web_id="GO ID"),
    _genes("hgnc", "Gene tree: groups", ("web_id",), tree_id="Group path"),
    _genes("kegg", "Gene tree: pathways", web_id="KEGG pathway", tree_id="Pathway ID"),
    _genes("type", "Gene tree: types", ("web_id",), tree_id="Gene type"),
    Result("sync_public_data", "Synchronised files", "json-docs", {"file": "File", "size_bytes": "Size (bytes)", "synced_at": "Synced at (UTC)"}, ("file",), "file"),
    Result("authors", "Authors", available=False),
)


def result(id_: str) -> Result:
    """The entry of an id, the first one for an unknown id."""
    return next((r for r in RESULTS if r.id == id_), RESULTS[0])
