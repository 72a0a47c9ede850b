"""Writers: tables that can be loaded again without doubling, exports, logs."""
