"""Fixed values.

These must equal the values of the staging tool whose behaviour the engine
reproduces: domains, the access-category map, relation predicates, the
datastream list, the bag document names, the administrative workflow tree and
the request option names.  They are listed plainly, in their natural order.
"""

# ---------------------------------------------------------------- fixed values
STATES = ["DRAFT", "SUBMITTED", "PUBLISHED", "MAINTENANCE"]
ARCHIVES = ["EASY", "DATAVAULT"]
FILE_RIGHTS = ["ANONYMOUS", "KNOWN", "RESTRICTED_REQUEST", "RESTRICTED_GROUP", "NONE"]
CREATOR_ROLES = ["ARCHIVIST", "DEPOSITOR"]

# dataset access category -> default accessible-to right of its files
ACCESS_CATEGORY_RIGHTS = [
    ("ANONYMOUS_ACCESS", "ANONYMOUS"),
    ("OPEN_ACCESS_FOR_REGISTERED_USERS", "KNOWN"),
    ("GROUP_ACCESS", "RESTRICTED_GROUP"),
    ("REQUEST_PERMISSION", "RESTRICTED_REQUEST"),
    ("OPEN_ACCESS", "ANONYMOUS"),
    ("NO_ACCESS", "NONE"),
    ("ACCESS_ELSEWHERE", "NONE"),
    ("FREELY_AVAILABLE", "ANONYMOUS"),
]
DEFAULT_VISIBLE_TO = "ANONYMOUS"

# request option defaults (blank cell = default)
REQUEST_DEFAULT_ACCESSIBLE = "NONE"
REQUEST_DEFAULT_VISIBLE = "ANONYMOUS"
REQUEST_DEFAULT_CREATOR_ROLE = "DEPOSITOR"

# request CSV option names (the long option names of the item command)
REQUEST_OPTIONS = [
    "path-in-dataset", "format", "datastream-location", "size", "file-location",
    "dataset-id", "accessible-to", "visible-to", "creator-role", "owner-id",
]

# loose boolean words (case-insensitive, no trimming)
TRUE_WORDS = ["true", "yes", "on"]

# relation predicates and objects
HAS_DOI = "http://dans.knaw.nl/ontologies/relations#hasDoi"
HAS_PID = "http://dans.knaw.nl/ontologies/relations#hasPid"
HAS_MODEL = "info:fedora/fedora-system:def/model#hasModel"
OAI_ITEM_ID = "http://www.openarchives.org/OAI/2.0/itemID"
IS_MEMBER_OF = "http://dans.knaw.nl/ontologies/relations#isMemberOf"
IS_MEMBER_OF_OAI_SET = "http://dans.knaw.nl/ontologies/relations#isMemberOfOAISet"
IS_SUBORDINATE_TO = "http://dans.knaw.nl/ontologies/relations#isSubordinateTo"
MODEL_RECURSIVE_ITEM = "info:fedora/dans-model:recursive-item-v1"
MODEL_DATASET = "info:fedora/easy-model:EDM1DATASET"
MODEL_OAI_ITEM = "info:fedora/easy-model:oai-item1"
MODEL_FILE = "info:fedora/easy-model:EDM1FILE"
MODEL_FOLDER = "info:fedora/easy-model:EDM1FOLDER"
MODEL_CONTAINER_ITEM = "info:fedora/dans-container-item-v1"
OAI_ID_PLACEHOLDER = "oai:easy.dans.knaw.nl:$sdo-id"
FEDORA_PREFIX = "info:fedora/"

NS_DATASET = "easy-dataset"
NS_FILE = "easy-file"
NS_FOLDER = "easy-folder"
DATASET_SDO = "DATASET_SDO~~RESERVED"
ADDITIONAL_LICENSE = "ADDITIONAL_LICENSE"

# dataset datastreams: (ord, content_file, ds_id, label, control_group, mime_type, condition)
# condition: None = always; otherwise the flag column that must be true
DATASET_DATASTREAMS = [
    (1, "AMD", "AMD", "Administrative metadata for this dataset", "X", "text/xml", None),
    (2, "EMD", "EMD", None, "X", "text/xml", None),
    (3, "PRSQL", "PRSQL", None, "X", "text/xml", None),
    (4, "dataset.xml", "dataset.xml", "DDM metadata for this dataset", "X", "text/xml", "bag_md"),
    (5, "files.xml", "files.xml", "File metadata for this dataset", "X", "text/xml", "bag_md"),
    (6, "manifest-sha1.txt", "manifest-sha1.txt", "Manifest (sha1) of the original bag", "M", "text/plain", "bag_md_manifest"),
    (7, "agreements.xml", "agreements.xml", "Agreement specific metadata for this dataset", "X", "text/xml", "bag_md_agreements"),
    (8, "message-from-depositor.txt", "message-from-depositor.txt", "Message from depositor to archivist about this dataset", "M", "text/plain", "bag_md_message"),
    (9, "ADDITIONAL_LICENSE", "ADDITIONAL_LICENSE", None, "M", None, "license"),
]
# the manifest datastream is written with key "dsId" (all others "dsID")
MANIFEST_DS_KEY = "dsId"

# bag documents: (name in bag, mandatory when bag metadata is requested)
BAG_DOCUMENTS = [
    ("metadata/dataset.xml", True),
    ("metadata/files.xml", True),
    ("manifest-sha1.txt", False),
    ("metadata/depositor-info/agreements.xml", False),
    ("metadata/depositor-info/message-from-depositor.txt", False),
]

# administrative workflow tree: (id, parent id, required, time_spent_writable)
WORKFLOW_TREE = [
    ("dataset", None, False, False),
    ("dataset.sip", "dataset", False, True),
    ("dataset.sip.files", "dataset.sip", False, False),
    ("dataset.sip.files.completeness", "dataset.sip.files", True, False),
    ("dataset.sip.files.accessibility", "dataset.sip.files", True, False),
    ("dataset.sip.files.privacy", "dataset.sip.files", True, False),
    ("dataset.sip.file-list", "dataset.sip", False, False),
    ("dataset.sip.file-list.file-metadata", "dataset.sip.file-list", False, False),
    ("dataset.sip.descriptive-metadata", "dataset.sip", False, False),
    ("dataset.sip.descriptive-metadata.completeness", "dataset.sip.descriptive-metadata", True, False),
    ("dataset.sip.descriptive-metadata.identifiers", "dataset.sip.descriptive-metadata", False, False),
    ("dataset.aip", "dataset", False, True),
    ("dataset.aip.file-conversion", "dataset.aip", False, False),
    ("dataset.aip.file-metadata", "dataset.aip", False, False),
    ("dataset.aip.structure", "dataset.aip", False, False),
    ("dataset.dip", "dataset", False, True),
    ("dataset.dip.publish-files", "dataset.dip", True, False),
    ("dataset.dip.jumpoff", "dataset.dip", False, False),
    ("dataset.dip.relations", "dataset.dip", False, False),
]
WORKFLOW_ASSIGNEE = "NOT_ASSIGNED"

# identifiers
SCHEME_PID = "PID"
SCHEME_DOI = "DOI"
SCHEME_DOI_OTHER_ACCESS = "DOI_OTHER_ACCESS"
SCHEME_DMO_ID = "DMO_ID"
PID_SYSTEM = "http://www.persistent-identifier.nl"
DOI_RESOLVER = "http://dx.doi.org"
DMO_ID_PLACEHOLDER = "$sdo-id"

# licences
DCTERMS_NS = "http://purl.org/dc/terms/"
FREE_TEXT_LICENSE_NAME = "additional_license.txt"
LICENSE_MIME = [("txt", "text/plain"), ("html", "text/html"), ("pdf", "application/pdf")]
TEMPLATE_RIGHTS_HOLDER = "<rightsHolder>"
TEMPLATE_YEAR = "<year>"

MAX_LABEL_LENGTH = 255
NOT_KNOWN = "NOT KNOWN"
EXTRA_DESCRIPTION_SCHEME = None

# reject messages (text written before / after the offending value)
MSG_OWNER_MISSING = "depositor.userId is missing"
MSG_MISSING_COLUMNS = "Missing columns: "
MSG_INVALID_STATE = "Not a valid state: "
MSG_URI_NOT_IN_BAG = "The fileUris map must reference a subset of all files in the bag. Not found in bag: "
MSG_NO_DATA_DIR = "Bag doesn't contain data directory."
MSG_DATASET_XML_MISSING = "Couldn't find metadata/dataset.xml"
MSG_INVALID_ARCHIVE = "Not a valid archive: "
MSG_NO_RIGHTS_HOLDER = "No dcterms:rightsHolder element found. There should be at least one"
MSG_CREATED_NOT_ONE = " ddm:created elements found. There must be exactly one"
MSG_BAD_CREATED = "Invalid format: "
MSG_LICENSE_COUNT = ("Found ", " dcterms:license elements. There should be exactly one")
MSG_UNKNOWN_LICENSE_URI = "Not a valid license URI: "
MSG_UNKNOWN_LICENSE_EXT = "Unknown extension for license: ."
MSG_URN_MISSING = "URN must be provided"
MSG_KEY_NOT_FOUND = "key not found: "
MSG_FILE_MISSING = ("File ", " does not exist")
MSG_BAD_URI_MAPPING_LINE = "Invalid line in input: "
MSG_BAD_MANIFEST_LINE = "Invalid line in manifest-sha1.txt: "
MSG_FILES_XML_MISSING = "Unable to find `metadata/files.xml` in bag."
MSG_FORMAT_NOT_UNIQUE = "format element doesn't exist for the file, or isn't unique."
MSG_BAD_URL = "Not a valid URL: "

# depositor remark sentences
PRIVACY_STATED = ("According to depositor ", " this dataset ", " contain Privacy Sensitive data.")
PRIVACY_DOES = "DOES"
PRIVACY_DOES_NOT = "DOES NOT"
PRIVACY_UNSTATED = ("No statement by ", " could be found whether this dataset contains Privacy Sensitive data.")
AGREEMENTS_INVALID = "File agreements.xml not valid: "

# XML namespaces of the rendered documents
NS_AMD = "http://easy.dans.knaw.nl/easy/dataset-administrative-metadata/"
NS_WORKFLOW = "http://easy.dans.knaw.nl/easy/workflow/"
NS_FILE_ITEM_MD = "http://easy.dans.knaw.nl/easy/file-item-md/"
NS_ITEM_CONTAINER_MD = "http://easy.dans.knaw.nl/easy/item-container-md/"
NS_PERMISSION_SEQUENCE_LIST = "http://easy.dans.knaw.nl/easy/permission-sequence-list/"
NS_FOXML = "info:fedora/fedora-system:def/foxml#"
NS_OAI_DC = "http://www.openarchives.org/OAI/2.0/oai_dc/"
NS_DC = "http://purl.org/dc/elements/1.1/"
NS_XSI = "http://www.w3.org/2001/XMLSchema-instance"

# failure order of the dataset stage (lower = earlier)
STAGE = {
    "owner_missing": -1,
    "bad_uri_mapping_line": 0,
    "invalid_state": 1,
    "uri_not_in_bag": 2,
    "no_data_dir": 3,
    "dataset_xml_missing": 4,
    "crosswalk_failed": 5,
    "invalid_archive": 6,
    "no_rights_holder": 7,
    "created_not_one": 8,
    "bad_created_date": 8,
    "license_count": 9,
    "unknown_license_uri": 9,
    "unknown_license_extension": 9,
    "urn_missing": 10,
    "unknown_audience": 11,
    "unknown_access_category": 11,
    "bag_metadata_missing": 12,
    "bad_manifest_line": 13,
    "files_xml_missing": 14,
    "format_not_unique": 14,
    "bad_url": 14,
    "uri_and_file": 14,
}
