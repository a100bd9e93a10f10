"""Writers: append, upsert, insert-ignore, snapshots, markers, exports."""
