"""Choosing and cross-checking the documents of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.clean import (
    blank_to_null, classify_document, document_priority, file_extension, file_name_date, is_customer_form, same_words,
    split_last_comma, standard_location,
)

from .ledger import only_in
from .scale import first_per_key


def newest_first(name: str) -> list[Column]:
    """Order of a job's files: best document type, then the newest file-name date, then the name."""
    d = file_name_date(name)
    return [document_priority("label"), F.desc(d["y"]), F.desc(d["m"]), F.desc(d["d"]), F.asc(name)]


def labelled(files: DataFrame, name: str, rules=None) -> DataFrame:
    """N32 for a listing: files with a document label, others dropped."""
    return files.withColumn("label", classify_document(name, rules)).where(F.col("label").isNotNull())


def best_type_files(files: DataFrame, job: str, name: str) -> DataFrame:
    """All files of the best document type a job has."""
    found = labelled(files, name).withColumn("_p", document_priority("label"))
    best = found.groupBy(job).agg(F.min("_p").alias("_p"))
    return found.join(best, [job, "_p"], "left_semi").drop("_p")


def first_seen_structures(items: DataFrame, job: str, structure: str, file_order: str) -> DataFrame:
    """The items of each structure from the first file that has it."""
    first = items.groupBy(job, structure).agg(F.min(file_order).alias(file_order))
    return items.join(first, [job, structure, file_order], "left_semi")


def pick_documents(files: DataFrame, job: str, name: str, structures: str, rules=None) -> DataFrame:
    """Per job the leading document, the shop drawing and their structure counts.

    Quotations only lead where nothing better exists.
    """
    found = labelled(files, name, rules or K.ARCHIVE_DOCUMENT_RULES)
    kind = (
        F.when(F.col("label") == "Shop Drawing PDF", "drawing")
        .when(F.startswith("label", F.lit("Quotation")), "quote").otherwise("bom")
    )
    best = first_per_key(found.withColumn("kind", kind), [job, "kind"], newest_first(name))
    pick = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))
    return best.groupBy(job).agg(
        F.coalesce(pick("bom", name), pick("quote", name)).alias("bom_file"),
        F.coalesce(pick("bom", "label"), pick("quote", "label")).alias("bom_doc_type"),
        F.when(pick("bom", name).isNotNull(), pick("bom", structures)).otherwise(pick("quote", structures)).alias("structure_count_bom"),
        pick("drawing", name).alias("shop_drawing_file"), pick("drawing", structures).alias("structure_count_drawing"),
    )


def pick_form(files: DataFrame, job: str, name: str, location: str, order: str) -> DataFrame:
    """The customer form that has a place, else the first form; any document where none is named."""
    docs = files.where(F.lower(name).endswith(".docx"))
    ranked = [
        F.desc(is_customer_form(name)), F.desc(blank_to_null(location).isNotNull()), F.asc(order)]
    return first_per_key(docs, [job], ranked)


def cross_check(records: DataFrame) -> DataFrame:
    """Conflicts between a job's documents.

    Input columns: job, location_bom, location_form, contractor_bom, customer_form,
    structure_count_bom, structure_count_drawing, documents (array of labels).
    """
    have_bom = F.arrays_overlap("documents", F.array(*[F.lit(x) for x in ("BOM by Structure XML", "BOM by Structure PDF", "BOM Summary PDF")]))
    missing = F.array_compact(F.array(
        F.when(~have_bom, F.lit("BOM")), F.when(~F.array_contains("documents", "NCF"), F.lit("NCF")),
        F.when(~F.array_contains("documents", "Shop Drawing PDF"), F.lit("Shop Drawing PDF"))))
    staged = records.withColumns({
        "location_bom": F.coalesce(standard_location("location_bom"), F.lit("")),
        "location_form": F.coalesce(standard_location("location_form"), F.lit("")),
    })
    bom, form = F.col("location_bom"), F.col("location_form")
    city, state = split_last_comma("location")
    conflict = (bom != "") & (form != "") & (bom != form)
    counts = F.col("structure_count_bom") != F.col("structure_count_drawing")
    return staged.withColumns({
        "location_conflict": conflict,
        "location_conflict_detail": F.when(conflict, F.concat(F.lit("BOM='"), bom, F.lit("'; NCF='"), form, F.lit("'"))),
        "location": F.when(bom != "", bom).otherwise(form),
        "location_source": F.when(bom != "", "BOM").when(form != "", "NCF").otherwise(""),
        "contractor_customer_match": same_words("contractor_bom", "customer_form"),
        "structure_count_conflict": F.coalesce(counts, F.lit(False)),
        "structure_count_conflict_detail": F.when(counts, F.concat(
            F.lit("BOM="), F.col("structure_count_bom"), F.lit("; ShopDrawing="), F.col("structure_count_drawing"))),
        "documents_missing": missing,
    }).withColumns({"city": F.coalesce(city, F.lit("")), "state": F.coalesce(state, F.lit(""))})


def document_conflicts(checked: DataFrame) -> DataFrame:
    """How many records disagree, and how many lack a document."""
    return checked.agg(
        F.count("*").alias("records"), F.count_if("location_conflict").alias("location_conflicts"),
        F.count_if("structure_count_conflict").alias("count_conflicts"),
        F.count_if(~F.col("contractor_customer_match")).alias("customer_mismatches"),
        F.count_if(F.array_contains("documents_missing", "BOM")).alias("missing_bom"),
        F.count_if(F.array_contains("documents_missing", "NCF")).alias("missing_form"))


def unclassified(files: DataFrame, name: str) -> DataFrame:
    """Q05: files no rule labels, known by-products left out."""
    ext = F.when(F.col(name).contains("."), file_extension(name)).otherwise(F.lit(""))
    open_files = files.where(classify_document(name).isNull() & ~is_customer_form(name))
    return open_files.withColumn("extension", ext).where(~F.col("extension").isin(K.SKIPPED_EXTENSIONS))


def missing_folders(folders: DataFrame, extracted: DataFrame, key: str) -> DataFrame:
    """Listed folders whose key the output lacks."""
    return only_in(folders, extracted, key)


def source_year_union(frames: dict[int, DataFrame], year: str = "year") -> DataFrame:
    """Yearly tables stacked by column name; columns a year lacks are NULL."""
    out = None
    for value, df in sorted(frames.items()):
        tagged = df.withColumn(year, F.lit(value))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out

