"""Tracker parameters and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TrackerConfig:
    """Association and track-management parameters.

    ``budget`` optionally bounds the appearance gallery per track (keep
    the most recent samples).  The default ``None`` keeps every sample of a
    live track, as the reference pipeline does; set a budget to bound
    streaming state when tracks live very long (results may then differ).
    """

    max_cosine: float = 0.3
    max_iou: float = 0.7
    max_age: int = 30
    n_init: int = 3
    budget: int | None = None
    nms_overlap: float = 1.0
    only_position: bool = False


# ---------------------------------------------------------------------------
# Fixed values (must equal the published model / statistics for equal results)
# ---------------------------------------------------------------------------

# 0.95 quantile of the chi-square distribution, degrees of freedom 1..9.
CHI2INV95 = {1: 3.8415, 2: 5.9915, 3: 7.8147, 4: 9.4877, 5: 11.070,
             6: 12.592, 7: 14.067, 8: 15.507, 9: 16.919}

# Cost given to infeasible (gated) associations.
INFTY_COST = 1e5

# Kalman noise weights relative to the box height.
STD_WEIGHT_POSITION = 1.0 / 20
STD_WEIGHT_VELOCITY = 1.0 / 160

# Default detector anchors, (w, h) pairs in pixels of a 416 x 416 input.
DEFAULT_ANCHORS = [(10, 13), (16, 30), (33, 23), (30, 61), (62, 45),
                   (59, 119), (116, 90), (156, 198), (373, 326)]

# Anchor ids served by output levels 0, 1, 2 (strides 32, 16, 8).
ANCHOR_MASK = [[6, 7, 8], [3, 4, 5], [0, 1, 2]]
LEVEL_STRIDES = [32, 16, 8]

# COCO class names, line order = class id.
COCO_CLASSES = [
    "person", "bicycle", "car", "motorbike", "aeroplane", "bus", "train",
    "truck", "boat", "traffic light", "fire hydrant", "stop sign",
    "parking meter", "bench", "bird", "cat", "dog", "horse", "sheep", "cow",
    "elephant", "bear", "zebra", "giraffe", "backpack", "umbrella", "handbag",
    "tie", "suitcase", "frisbee", "skis", "snowboard", "sports ball", "kite",
    "baseball bat", "baseball glove", "skateboard", "surfboard",
    "tennis racket", "bottle", "wine glass", "cup", "fork", "knife", "spoon",
    "bowl", "banana", "apple", "sandwich", "orange", "broccoli", "carrot",
    "hot dog", "pizza", "donut", "cake", "chair", "sofa", "pottedplant",
    "bed", "diningtable", "toilet", "tvmonitor", "laptop", "mouse", "remote",
    "keyboard", "cell phone", "microwave", "oven", "toaster", "sink",
    "refrigerator", "book", "clock", "vase", "scissors", "teddy bear",
    "hair drier", "toothbrush",
]

# Wire formats.
FRAME_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"   # strptime %Y-%m-%dT%H:%M:%S.%f
