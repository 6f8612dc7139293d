"""Writers: ordered exports, the prediction store and published tables."""
