"""The field names of the schemas. A missing value, null and the empty text are one state."""

from pyspark.sql import types as T

_strings = lambda *names: [T.StructField(n, T.StringType()) for n in names]

INTELLIGENCE = T.StructType([T.StructField("is_relevant", T.BooleanType()), *_strings("service_category", "summary", "why_selected"), T.StructField("confidence", T.DoubleType())])
OPPORTUNITY = T.StructType([
    T.StructField("pos", T.LongType()), *_strings("title", "description", "snippet", "summary", "organization", "location", "source", "source_url", "deadline", "email", "phone", "tender_type", "emd", "document_fee", "discovery_source", "discovery_reasoning"),
    T.StructField("discovery_score", T.IntegerType()), T.StructField("intelligence", INTELLIGENCE),
])
PARSED = T.StructType(_strings("title", "organization", "deadline", "location", "description", "tender_type", "emd", "document_fee", "email", "phone"))
FETCH = T.StructType([
    T.StructField("success", T.BooleanType()), T.StructField("content", T.BinaryType()), *_strings("content_type", "mime_type", "content_hash"), T.StructField("content_size", T.LongType()),
    *_strings("url", "final_url"), T.StructField("status_code", T.IntegerType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("redirects", T.IntegerType()),
    T.StructField("download_time", T.DoubleType()), *_strings("error", "error_type"),
])
STORE = T.StructType([
    *_strings("Opportunity_ID", "Type", "Title", "Organization", "Service_Category", "Location", "Source", "Source_Link", "Deadline", "Contact_Status", "Opportunity_Status", "Priority"),
    T.StructField("Score", T.DoubleType()), T.StructField("Qualified", T.BooleanType()), T.StructField("Qualification_Score", T.DoubleType()),
    *_strings("Recommended_Action", "Qualification_Reasoning", "Summary", "Assigned_To", "Last_Updated", "Date_Added"),
])
ACTIVITY = T.StructType([*_strings("Timestamp", "Agent", "Action"), T.StructField("Records_Added", T.IntegerType()), *_strings("Notes")])
CONTACT = T.StructType(_strings("Contact_ID", "Name", "Designation", "Company", "Email", "Phone", "LinkedIn", "Source", "Notes", "Date_Added"))
SOURCE = T.StructType([
    *_strings("name", "url", "category", "portal_type"), *[T.StructField(n, T.ArrayType(T.StringType())) for n in ("keywords", "services", "sectors", "states", "paths")],
    T.StructField("priority", T.IntegerType()), T.StructField("enabled", T.BooleanType()),
])
#: Fields of a merged record that only extraction may give.
AUTHORITATIVE = ["title", "organization", "deadline", "location", "description", "tender_type", "emd", "document_fee", "email", "phone", "source_url"]
