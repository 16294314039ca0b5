"""Writers: table versions, file chunks, CSV export."""
