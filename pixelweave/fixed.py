"""Fixed values. They decide results, so they are stated once, here, as plain data."""

# Classes kept for training. The order defines the class index.
TARGET_CLASSES = ("person", "cat", "dog", "car", "chair")

# Per-channel statistics of the standardisation step, in R, G, B order.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)

# Image geometry (height, width, channels) and the top of the 8-bit pixel range.
IMAGE_SHAPE = (224, 224, 3)
PIXEL_MAX = 255.0

# Names of images, chunks and batches.
IMAGE_NAME_FORMAT = "coco_%06d.jpg"
IMAGE_GLOB = "coco_*.{jpg,png}"
CHUNK_NAME_FORMATS = {"images": "images_chunk_%d", "labels": "labels_chunk_%d"}
BATCH_PREFIX = "batch_"
UNKNOWN_LABEL = "unknown"

# Layout sizes.
CHUNK_SIZE = 50
CHUNKS_PER_BATCH = 10
MINIBATCH_SIZE = 32
FALLBACK_CLASSES = 80

# Splits of a data set, and the row caps of a run that wants the published sizes.
SPLITS = ("train", "validation", "test")
SPLIT_CAPS = {"train": 64000, "validation": 8000, "test": 8000}

# Training settings and the probability floor of the cross-entropy.
EPOCHS = 10
LEARNING_RATE = 0.001
PROBABILITY_FLOOR = 1e-7
