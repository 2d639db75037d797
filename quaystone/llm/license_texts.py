"""Public license notices, titles and texts by SPDX name.

Texts of up to some 250 words are whole, without copyright lines and numbers of clauses. Of longer
ones (Apache, GNU, MPL, EPL, CC) there are the title and the notices that they ask files to carry.
"""

# Public license notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
        "the Apache License, Version 2.0",
        "licensed under the Apache License 2.0",
        "licensed under Apache License 2.0",
        "licensed under Apache 2.0",
        "licensed under the Apache 2.0 license",
        "licensed under Apache-2.0",
        "released under the Apache License 2.0",
        "released under the Apache 2.0 license",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
        " the specific language governing permissions and limitations under the License.",
        "either of Apache License, Version 2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "The MIT License (MIT)",
        "under the MIT License",
        "under MIT License",
        "under the terms of the MIT License",
        "licensed under MIT",
        "released under MIT",
        "or the MIT License",
        "or MIT license at your option",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "GNU General Public License Version 3, 29 June 2007",
        "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "free software: you can redistribute it and/or modify it under the terms of version 3 of the GNU General Public"
        " License as published by the Free Software Foundation.",
        "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "version 3 as published by the Free Software Foundation.",
        "licensed under the GNU General Public License v3",
        "licensed under the GNU General Public License, version 3",
        "licensed under GPLv3",
        "licensed under the GPLv3",
        "licensed under the GPL v3",
        "licensed under the GPL, version 3",
        "released under the GNU General Public License, version 3",
        "released under the GNU General Public License v3",
        "released under the GPLv3",
        "released under GPLv3",
        "under the terms of the GNU General Public License, version 3",
        "under the terms of the GNU General Public License v3",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License Version 2, June 1991",
        "free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
        "free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public"
        " License as published by the Free Software Foundation.",
        "free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "version 2 as published by the Free Software Foundation.",
        "licensed under the GNU General Public License v2",
        "licensed under the GNU General Public License, version 2",
        "licensed under GPLv2",
        "licensed under the GPLv2",
        "licensed under the GPL v2",
        "licensed under the GPL, version 2",
        "released under the GNU General Public License, version 2",
        "released under the GNU General Public License v2",
        "released under the GPLv2",
        "released under GPLv2",
        "under the terms of the GNU General Public License, version 2",
        "under the terms of the GNU General Public License v2",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
        "free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
        "free software: you can redistribute it and/or modify it under the terms of version 3 of the GNU Lesser General"
        " Public License as published by the Free Software Foundation.",
        "free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License version 3 as published by the Free Software Foundation.",
        "licensed under the GNU Lesser General Public License v3",
        "licensed under the GNU Lesser General Public License, version 3",
        "licensed under LGPLv3",
        "licensed under the LGPLv3",
        "licensed under the LGPL v3",
        "licensed under the LGPL, version 3",
        "released under the GNU Lesser General Public License, version 3",
        "released under the GNU Lesser General Public License v3",
        "released under the LGPLv3",
        "released under LGPLv3",
        "under the terms of the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License v3",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License Version 3, 19 November 2007",
        "free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
        "free software: you can redistribute it and/or modify it under the terms of version 3 of the GNU Affero General"
        " Public License as published by the Free Software Foundation.",
        "free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License version 3 as published by the Free Software Foundation.",
        "licensed under the GNU Affero General Public License v3",
        "licensed under the GNU Affero General Public License, version 3",
        "licensed under AGPLv3",
        "licensed under the AGPLv3",
        "licensed under the AGPL v3",
        "licensed under the AGPL, version 3",
        "released under the GNU Affero General Public License, version 3",
        "released under the GNU Affero General Public License v3",
        "released under the AGPLv3",
        "released under AGPLv3",
        "under the terms of the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License v3",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "licensed under the BSD-3-Clause license",
        "licensed under the 3-clause BSD license",
        "released under the 3-clause BSD license",
        "released under the BSD 3-Clause License",
        "licensed under the New BSD License",
        "licensed under the Modified BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "licensed under the BSD-2-Clause license",
        "licensed under the 2-clause BSD license",
        "released under the 2-clause BSD license",
        "released under the BSD 2-Clause License",
        "licensed under the Simplified BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
        " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR"
        " BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
        "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
        "Mozilla Public License, v. 2.0",
        "Mozilla Public License 2.0",
        "licensed under the MPL 2.0",
        "licensed under MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC-BY-4.0.",
        "licensed under a Creative Commons Attribution 4.0 International License",
        "licensed under the Creative Commons Attribution 4.0 International License",
        "licensed under a Creative Commons Attribution 4.0 License",
        "Creative Commons Attribution 4.0 International",
        "creativecommons.org/licenses/by/4.0",
        "Attribution 4.0 International Public License",
        "Attribution 4.0 International Creative Commons Corporation",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC-BY-SA-4.0.",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "licensed under the Creative Commons Attribution-ShareAlike 4.0 International License",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 License",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "creativecommons.org/licenses/by-sa/4.0",
        "Attribution-ShareAlike 4.0 International Public License",
        "Attribution-ShareAlike 4.0 International Creative Commons Corporation",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC-BY-NC-4.0.",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "licensed under the Creative Commons Attribution-NonCommercial 4.0 International License",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 License",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "creativecommons.org/licenses/by-nc/4.0",
        "Attribution-NonCommercial 4.0 International Public License",
        "Attribution-NonCommercial 4.0 International Creative Commons Corporation",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "Licensed under CC0 1.0.",
        "Licensed under CC0-1.0.",
        "CC0 1.0 Universal License",
        "CC0 1.0 Universal Public Domain Dedication",
        "Creative Commons CC0 1.0 Universal",
        "Creative Commons Legal Code CC0 1.0 Universal",
        "creativecommons.org/publicdomain/zero/1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    "LGPL-2.1": (
        "GNU Lesser General Public License Version 2.1, February 1999",
        "free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
        "free software; you can redistribute it and/or modify it under the terms of version 2.1 of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License version 2.1 as published by the Free Software Foundation.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "licensed under the GNU Lesser General Public License v2.1",
        "licensed under the GNU Lesser General Public License, version 2.1",
        "licensed under LGPLv2.1",
        "licensed under the LGPLv2.1",
        "licensed under the LGPL v2.1",
        "licensed under the LGPL, version 2.1",
        "released under the GNU Lesser General Public License, version 2.1",
        "released under the GNU Lesser General Public License v2.1",
        "released under the LGPLv2.1",
        "released under LGPLv2.1",
        "under the terms of the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License v2.1",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Released under the ISC License.",
        "under the terms of the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Zlib": (
        "Licensed under the zlib License.",
        "Released under the zlib License.",
        "licensed under the zlib/libpng license",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. Altered source versions must be plainly marked"
        " as such, and must not be misrepresented as being the original software. This notice may not be removed or "
        "altered from any source distribution.",
    ),
    "BSL-1.0": (
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
        "under the Boost Software License, Version 1.0",
        "Licensed under the Boost Software License 1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit"
        " third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices"
        " in the Software and this entire statement, including the above license grant, this restriction and the "
        "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
        "works of the Software, unless such copies or derivative works are solely in the form of machine-executable "
        "object code generated by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING"
        " THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING "
        "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        "Licensed under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our "
        "heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all "
        "present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "EPL-1.0": (
        "Eclipse Public License - v 1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0",
        "the Eclipse Public License v1.0",
        "the Eclipse Public License 1.0",
        "the Eclipse Public License, version 1.0",
    ),
    "EPL-2.0": (
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0",
        "the Eclipse Public License v2.0",
        "the Eclipse Public License 2.0",
        "the Eclipse Public License, version 2.0",
    ),
    "CC-BY-3.0": (
        "Licensed under CC BY 3.0.",
        "Licensed under CC-BY-3.0.",
        "licensed under a Creative Commons Attribution 3.0 Unported License",
        "licensed under the Creative Commons Attribution 3.0 Unported License",
        "licensed under a Creative Commons Attribution 3.0 License",
        "Creative Commons Attribution 3.0 Unported",
        "creativecommons.org/licenses/by/3.0",
    ),
    "CC-BY-SA-3.0": (
        "Licensed under CC BY-SA 3.0.",
        "Licensed under CC-BY-SA-3.0.",
        "licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
        "licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License",
        "licensed under a Creative Commons Attribution-ShareAlike 3.0 License",
        "Creative Commons Attribution-ShareAlike 3.0 Unported",
        "creativecommons.org/licenses/by-sa/3.0",
    ),
    "CC-BY-NC-3.0": (
        "Licensed under CC BY-NC 3.0.",
        "Licensed under CC-BY-NC-3.0.",
        "licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License",
        "licensed under the Creative Commons Attribution-NonCommercial 3.0 Unported License",
        "licensed under a Creative Commons Attribution-NonCommercial 3.0 License",
        "Creative Commons Attribution-NonCommercial 3.0 Unported",
        "creativecommons.org/licenses/by-nc/3.0",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC-BY-NC-SA-4.0.",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
        "licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 License",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International",
        "creativecommons.org/licenses/by-nc-sa/4.0",
        "Attribution-NonCommercial-ShareAlike 4.0 International Public License",
        "Attribution-NonCommercial-ShareAlike 4.0 International Creative Commons Corporation",
    ),
    "CC-BY-NC-SA-3.0": (
        "Licensed under CC BY-NC-SA 3.0.",
        "Licensed under CC-BY-NC-SA-3.0.",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License",
        "licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 License",
        "Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported",
        "creativecommons.org/licenses/by-nc-sa/3.0",
    ),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "Licensed under CC-BY-ND-4.0.",
        "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
        "licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License",
        "licensed under a Creative Commons Attribution-NoDerivatives 4.0 License",
        "Creative Commons Attribution-NoDerivatives 4.0 International",
        "creativecommons.org/licenses/by-nd/4.0",
        "Attribution-NoDerivatives 4.0 International Public License",
        "Attribution-NoDerivatives 4.0 International Creative Commons Corporation",
    ),
    "CC-BY-ND-3.0": (
        "Licensed under CC BY-ND 3.0.",
        "Licensed under CC-BY-ND-3.0.",
        "licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License",
        "licensed under the Creative Commons Attribution-NoDerivs 3.0 Unported License",
        "licensed under a Creative Commons Attribution-NoDerivs 3.0 License",
        "Creative Commons Attribution-NoDerivs 3.0 Unported",
        "creativecommons.org/licenses/by-nd/3.0",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "Licensed under CC-BY-NC-ND-4.0.",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
        "licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 License",
        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International",
        "creativecommons.org/licenses/by-nc-nd/4.0",
        "Attribution-NonCommercial-NoDerivatives 4.0 International Public License",
        "Attribution-NonCommercial-NoDerivatives 4.0 International Creative Commons Corporation",
    ),
    "CC-BY-NC-ND-3.0": (
        "Licensed under CC BY-NC-ND 3.0.",
        "Licensed under CC-BY-NC-ND-3.0.",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License",
        "licensed under the Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 License",
        "Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported",
        "creativecommons.org/licenses/by-nc-nd/3.0",
    ),
}
