"""Settings of the tracking engine, with their names and defaults, and the two presets.

The names are those that configuration files use, so a JSON configuration
loads as it is; unknown fields are an error. Three settings are known and change
nothing, as what they rule is Spark's or is not built: videoDirPath and
plotEvaluationGraphs (drawing), mtmcPlusNumProcessesMax (Spark's tasks).
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

AGGLOMERATIVE, HDBSCAN = "AgglomerativeClustering", "HDBSCAN"
HAUSDORFF, PAIRWISE = "Hausdorff", "pairwise"


# Setting names and defaults.
@dataclass(frozen=True)
class IOConfig:
    enableDebug: bool = False
    inMtmcPlusBatchMode: bool = False
    batchId: str = "0"
    selectedSensorIds: tuple[str, ...] = ()
    outputDirPath: str = ""
    videoDirPath: str = ""
    jsonDataPath: str = ""
    protobufDataPath: str = ""
    groundTruthPath: str = ""
    groundTruthFrameIdOffset: int = 1
    useFullBodyGroundTruth: bool = False
    use3dEvaluation: bool = False
    plotEvaluationGraphs: bool = False


@dataclass(frozen=True)
class PreprocessingConfig:
    filterByRegionsOfInterest: bool = False
    timestampThreshMin: float | None = None
    locationBboxBottomGapThresh: float = 0.02
    locationConfidenceThresh: float = 0.5
    locationBboxAreaThresh: float = 0.0008
    locationBboxAspectRatioThresh: float = 0.6
    embeddingBboxBottomGapThresh: float = 0.02
    embeddingConfidenceThresh: float = 0.5
    embeddingBboxAreaThresh: float = 0.0008
    embeddingBboxAspectRatioThresh: float = 0.6
    embeddingVisibilityThresh: float = 0.5
    behaviorConfidenceThresh: float = 0.45
    behaviorBboxAreaThresh: float = 0.0007
    behaviorBboxAspectRatioThresh: float = 0.75
    behaviorLengthThreshSec: float = 0.0
    shortBehaviorFinishThreshSec: float | None = None
    behaviorNumLocationsMax: int = 9000
    behaviorSplitThreshSec: int = 6
    behaviorRetentionInStateSec: float = 600.0
    mtmcPlusRetentionInStateSec: float = 10.0
    mtmcPlusInitBufferLenSec: float = 10.0
    mtmcPlusReinitRatioAssignedBehaviors: float = 0.75
    mtmcPlusReinitDiffRatioClusters: float | None = None


@dataclass(frozen=True)
class LocalizationConfig:
    rectifyBboxByCalibration: bool = False
    peopleHeightMaxLengthSec: int = 600
    peopleHeightNumSamplesMax: int = 1000
    peopleHeightNumBatchFrames: int = 10000
    peopleHeightEstimationRatio: float = 0.7
    peopleHeightVisibilityThresh: float = 0.8
    overwrittenPeopleHeightMeter: float | None = None


@dataclass(frozen=True)
class ClusteringConfig:
    clusteringAlgo: str = HDBSCAN
    overwrittenNumClusters: int | None = None
    agglomerativeClusteringDistThresh: float = 3.5
    hdbscanMinClusterSize: int = 5
    numReassignmentIterations: int = 4
    reassignmentDistLooseThresh: float = 1.0
    reassignmentDistTightThresh: float = 0.12
    spatioTemporalDistLambda: float = 0.15
    spatioTemporalDistType: str = HAUSDORFF
    spatioTemporalDirMagnitudeThresh: float = 0.5
    enableOnlineSpatioTemporalConstraint: bool = False
    onlineSpatioTemporalDistThresh: float | None = None
    suppressOverlappingBehaviors: bool = False
    meanEmbeddingsUpdateRate: float = 0.1
    skipAssignedBehaviors: bool = True
    enableOnlineDynamicUpdate: bool = True
    dynamicUpdateAppearanceDistThresh: float = 0.2
    dynamicUpdateSpatioTemporalDistThresh: float = 10.0
    dynamicUpdateLengthThreshSec: float = 9.0

    def __post_init__(self) -> None:
        if self.clusteringAlgo not in (AGGLOMERATIVE, HDBSCAN):
            raise ValueError(f"unknown clusteringAlgo {self.clusteringAlgo}")
        if self.spatioTemporalDistType not in (HAUSDORFF, PAIRWISE):
            raise ValueError(f"unknown spatioTemporalDistType {self.spatioTemporalDistType}")
        if not 0 <= self.spatioTemporalDistLambda <= 1:
            raise ValueError("spatioTemporalDistLambda lies in [0, 1]")


@dataclass(frozen=True)
class StreamingConfig:
    kafkaBootstrapServers: str = "localhost:9092"
    kafkaProducerLingerMs: int = 0
    kafkaMicroBatchIntervalSec: float = 60.0
    kafkaRawConsumerPollTimeoutMs: int = 10000
    kafkaNotificationConsumerPollTimeoutMs: int = 100
    kafkaConsumerMaxRecordsPerPoll: int = 100000
    sendEmptyMtmcPlusMessages: bool = True
    mtmcPlusFrameBatchSizeMs: int = 180
    mtmcPlusBehaviorBatchesConsumed: int = 4
    mtmcPlusFrameBufferResetSec: float = 4.0
    mtmcPlusTimestampDelayMs: int = 100
    mtmcPlusLocationWindowSec: float = 1.0
    mtmcPlusSmoothingWindowSec: float = 1.0
    mtmcPlusNumProcessesMax: int = 8


@dataclass(frozen=True)
class AppConfig:
    io: IOConfig = field(default_factory=IOConfig)
    preprocessing: PreprocessingConfig = field(default_factory=PreprocessingConfig)
    localization: LocalizationConfig = field(default_factory=LocalizationConfig)
    clustering: ClusteringConfig = field(default_factory=ClusteringConfig)
    streaming: StreamingConfig = field(default_factory=StreamingConfig)
    #: "fixed" repairs the quirks listed in the README, "faithful" keeps them where a flag exists.
    quirks: str = "fixed"
    #: The clock for recency and retention; None: the newest end in the data.
    as_of: datetime | None = None


def clock(config: AppConfig) -> datetime | None:
    """The time that retention goes by: a set one, or with faithful quirks on a live stream the wall clock; None: the newest end in the data."""
    if config.as_of is None and config.quirks == "faithful" and not config.io.inMtmcPlusBatchMode:
        return datetime.now(timezone.utc)
    return config.as_of


_SECTIONS = {"io": IOConfig, "preprocessing": PreprocessingConfig, "localization": LocalizationConfig, "clustering": ClusteringConfig, "streaming": StreamingConfig}


def load_config(source: str | dict[str, Any]) -> AppConfig:
    """A configuration from a JSON text or a dictionary."""
    tree = json.loads(source) if isinstance(source, str) else source
    return updated(AppConfig(), tree, frozenset())


def updated(config: AppConfig, changes: dict[str, Any], locked: frozenset[str] = frozenset({"io", "streaming"})) -> AppConfig:
    """``config`` with some fields replaced; locked sections ignore changes, unknown names are an error."""
    parts = {}
    for section, values in changes.items():
        if section in locked:
            continue
        if section not in _SECTIONS:
            raise ValueError(f"unknown section {section}")
        known = {f.name for f in dataclasses.fields(_SECTIONS[section])}
        if unknown := set(values) - known:
            raise ValueError(f"unknown fields in {section}: {sorted(unknown)}")
        parts[section] = dataclasses.replace(getattr(config, section), **{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
    return dataclasses.replace(config, **parts)


# The two presets.
MTMC_PRESET = {
    "preprocessing": {"behaviorNumLocationsMax": 9000, "behaviorRetentionInStateSec": 600.0},
    "clustering": {"clusteringAlgo": HDBSCAN, "hdbscanMinClusterSize": 2, "numReassignmentIterations": 4, "spatioTemporalDistType": HAUSDORFF},
    "streaming": {"kafkaMicroBatchIntervalSec": 60.0},
}
RTLS_PRESET = {
    "preprocessing": {"behaviorNumLocationsMax": 1000, "behaviorRetentionInStateSec": 5.0, "mtmcPlusRetentionInStateSec": 5.0, "mtmcPlusInitBufferLenSec": 10.0},
    "clustering": {
        "clusteringAlgo": AGGLOMERATIVE,
        "agglomerativeClusteringDistThresh": 0.95,
        "numReassignmentIterations": 2,
        "reassignmentDistLooseThresh": 0.25,
        "spatioTemporalDistType": PAIRWISE,
        "spatioTemporalDistLambda": 0.15,
        "enableOnlineSpatioTemporalConstraint": True,
        "onlineSpatioTemporalDistThresh": 15.0,
    },
    "streaming": {"kafkaMicroBatchIntervalSec": 1.0},
}
