"""Spark schemas of the engine's records."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _S, _L, _TS, _B = T.DoubleType(), T.StringType(), T.LongType(), T.TimestampType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


POINT = _struct(x=_D, y=_D)
NAME_VALUE = T.MapType(_S, _S)
MATRIX = T.ArrayType(T.ArrayType(_D))

BBOX = _struct(leftX=_D, topY=_D, rightX=_D, bottomY=_D)
OBJECT = _struct(id=_S, bbox=BBOX, type=_S, confidence=_D, info=T.MapType(_S, _S), embedding=T.ArrayType(_D))
FRAME = _struct(version=_S, id=_S, timestamp=_TS, sensorId=_S, objects=T.ArrayType(OBJECT))

#: The central model: a row for each detection of a tracklet. A null location with location_valid set is a valid box that can't be placed.
TRACK_POINT = _struct(
    sensor_id=_S, object_id=_S, object_type=_S, ts=_TS, frame_id=_L, left_x=_D, top_y=_D, right_x=_D, bottom_y=_D, confidence=_D,
    location=POINT, location_valid=_B, embedding=T.ArrayType(_D), embedding_valid=_B, in_roi=_B, place=_S,
)

BEHAVIOR = _struct(
    key=_S, id=_S, sensorId=_S, objectId=_S, objectType=_S, timestamp=_TS, end=_TS, startFrame=_S, endFrame=_S, place=_S, matchedSystemTimestamp=_TS,
    timestamps=T.ArrayType(_TS), frameIds=T.ArrayType(_S), bboxes=T.ArrayType(BBOX), confidences=T.ArrayType(_D), locations=T.ArrayType(T.ArrayType(_D)),
    locationMask=T.ArrayType(_B), embeddings=T.ArrayType(T.ArrayType(_D)), embeddingMask=T.ArrayType(_B), roiMask=T.ArrayType(_B),
)
MTMC_OBJECT = _struct(batchId=_S, globalId=_S, objectType=_S, timestamp=_TS, end=_TS, matched=T.ArrayType(BEHAVIOR))
RTLS_COUNT = _struct(type=_S, count=T.IntegerType())
RTLS_LOCATION = _struct(id=_S, type=_S, locations=T.ArrayType(T.ArrayType(_D)), matchedBehaviorKeys=T.ArrayType(_S))
RTLS_ROW = _struct(place=_S, timestamp=_TS, frameId=_S, objectCounts=T.ArrayType(RTLS_COUNT), locationsOfObjects=T.ArrayType(RTLS_LOCATION))

SENSOR = _struct(
    type=_S, id=_S, origin=T.MapType(_S, _D), geoLocation=T.MapType(_S, _D), coordinates=T.MapType(_S, _D), translationToGlobalCoordinates=T.MapType(_S, _D), scaleFactor=_D,
    attributes=T.ArrayType(NAME_VALUE), place=T.ArrayType(NAME_VALUE), imageCoordinates=T.ArrayType(POINT), globalCoordinates=T.ArrayType(POINT),
    intrinsicMatrix=MATRIX, extrinsicMatrix=MATRIX, cameraMatrix=MATRIX, homography=MATRIX, tripwires=T.ArrayType(NAME_VALUE), rois=T.ArrayType(_struct(roiCoordinates=T.ArrayType(POINT))),
)
SENSOR_STATE = _struct(
    sensor_id=_S, place=_S, frame_width=T.IntegerType(), frame_height=T.IntegerType(), fps=_D, direction=_D, field_of_view=_S,
    homography=T.ArrayType(_D), rois=T.ArrayType(T.ArrayType(POINT)),
)
GROUND_TRUTH = _struct(CameraId=_D, Id=_D, FrameId=_D, X=_D, Y=_D, Width=_D, Height=_D, Xworld=_D, Yworld=_D)
MOT_ROW = _struct(FrameId=_L, Id=_L, X=_D, Y=_D, Width=_D, Height=_D, Conf=_D, Xworld=_D, Yworld=_D, Zworld=_D)

#: Kinds of the wire format that are declared but carry no operator: their fields, for readers of raw messages.
MESSAGE_KINDS = {
    "Keypoint": _struct(name=_S, coordinates=T.ArrayType(_D), quaternion=T.ArrayType(_D)),
    "Gaze": _struct(x=_D, y=_D, z=_D, theta=_D, phi=_D),
    "LipActivity": _struct(classLabel=_S),
    "Event": _struct(id=_S, type=_S, info=T.MapType(_S, _S)),
    "AnalyticsModule": _struct(id=_S, description=_S, source=_S, version=_S, info=T.MapType(_S, _S)),
    "Place": _struct(id=_S, name=_S, type=_S, info=T.MapType(_S, _S)),
}
