"""Incremental runs of the batch jobs over folders that receive new files.

The reference has no streaming operator; its jobs read a CSV file, clean or
profile it, and write the result.  Here the same batch operators run on
each micro-batch of newly arrived files (Structured Streaming file source +
``foreachBatch``), with the stream's checkpoint recording which files were
done.
"""
