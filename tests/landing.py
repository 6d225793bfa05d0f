"""Landed page folders for the ingest tests."""

import json
import os

from gridlens.sources.pages import page_file_name


def land_pages(folder, records, page_size=2, total=None):
    """Write records as API page envelopes named by zero-padded offset."""
    os.makedirs(folder, exist_ok=True)
    total = len(records) if total is None else total
    for offset in range(0, max(len(records), 1), page_size):
        page = records[offset:offset + page_size]
        with open(os.path.join(folder, page_file_name(offset)), "w") as fh:
            json.dump({"response": {"total": str(total), "data": page}}, fh)
