"""Scrape targets from pod snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricspark.functions.labels import label
from metricspark.schema import LABELS

# The standard annotation namespace, and what is assumed without annotations.
STANDARD_NAMESPACE = "prometheus.io"
DEFAULT_PORT = 80
DEFAULT_PATH = "metrics"
DEFAULT_METADATA = "pod,instance,namespace"


def target_of(pod: Column, own: str, enabled: Sequence[str]) -> Column:
    """``struct<name,url,labels>`` of a pod, or null if it is not to be scraped.

    ``enabled`` lists the annotation namespaces whose ``/scrape`` key turns scraping on by
    being there; its value does not matter. The own namespace goes before the standard one,
    and a port that is no number from 0 to 65535 becomes 80 without trying the other.
    """
    notes = pod["annotations"]
    note = lambda ns, what: F.try_element_at(notes, F.lit(f"{ns}/{what}"))
    either = lambda what: F.coalesce(note(own, what), note(STANDARD_NAMESPACE, what))
    asked = F.lit(False)
    for ns in enabled:
        asked = asked | F.coalesce(F.map_contains_key(notes, F.lit(f"{ns}/scrape")), F.lit(False))
    number = F.when(either("port").rlike(r"^\+?[0-9]+$"), either("port").try_cast("int"))
    port = F.when(number.between(0, 65535), number).otherwise(DEFAULT_PORT)
    path = F.coalesce(F.ltrim(either("path"), F.lit("/")), F.lit(DEFAULT_PATH))
    wanted = F.split(F.coalesce(note(own, "metadata"), F.lit(DEFAULT_METADATA)), ",")
    value = lambda k: (
        F.when(k == "pod", pod["name"]).when(k == "instance", pod["host_ip"]).when(k == "namespace", pod["namespace"])
    )
    labels = F.transform(
        F.filter(wanted, lambda k: k.isin("pod", "instance", "namespace")), lambda k: label(k, value(k))
    )
    return F.when(
        asked & pod["pod_ip"].isNotNull() & pod["name"].isNotNull(),
        F.struct(
            pod["name"].alias("name"),
            F.concat(F.lit("http://"), pod["pod_ip"], F.lit(":"), port.cast("string"), F.lit("/"), path).alias("url"),
            labels.cast(LABELS).alias("labels"),
        ),
    )


def discover_targets(pods: DataFrame, own: str, enabled: Sequence[str] | None = None) -> DataFrame:
    """``name, url, labels`` of the running pods to be scraped. Labels may have null values,
    which :func:`metricspark.functions.labels.with_static_labels` leaves out."""
    enabled = [own, STANDARD_NAMESPACE] if enabled is None else enabled
    columns = ("name", "namespace", "pod_ip", "host_ip", "annotations")
    pod = F.struct(*[F.col(c) for c in columns])
    running = pods.filter(F.col("phase") == "Running")
    targets = running.select(target_of(pod, own, enabled).alias("t"))
    return targets.filter("t IS NOT NULL").select("t.*")
