from rollcall.sources.results import read_in_order, read_results
from rollcall.sources.xml_records import XmlRecordSource, read_xml_records

__all__ = ["XmlRecordSource", "read_in_order", "read_results", "read_xml_records"]
