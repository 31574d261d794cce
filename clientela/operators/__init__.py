"""The segmentation steps as DataFrame operators."""
